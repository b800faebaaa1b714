import random

import pytest
from pyspark.sql import functions as F

from quillon.functions.alignment import md5_rank
from quillon.operators.context import conversation_window, decided_transcript, group_tracks, map_points, split_key
from quillon.operators.ensemble import agreement_score, classify_tier, clique_size, confidence_score, is_non_speech, pair_similarities
from quillon.operators.review import effective, published, replay, review_offset, training_rows
from quillon.operators.snapshot import snapshot
from quillon.operators.tables import duration_buckets, join_voters, last_wins, pending, shard_counts
from quillon.operators.worklist import flag_reviewed, queue_counts, review_plan, review_queue
from quillon.session import numbered


def test_agreement_and_clique(spark):
    rows = [("a b c d e", "a b c d e", "a b c d e", 3), ("a b c d e", "a b c d e", "x y", 2), ("a b", "c d", "e f", 1)]
    pairs = pair_similarities([F.col(c) for c in "abc"])
    got = spark.createDataFrame(rows, "a string, b string, c string, n int").select("n", clique_size(pairs, 3).alias("k"), agreement_score(list(pairs.values())).alias("s")).collect()
    assert [r["k"] for r in got] == [r["n"] for r in got] and got[0]["s"] == 1.0 and got[2]["s"] == 0.0


def test_tier_speech_confidence(spark):
    df = spark.createDataFrame([(False, 3, True, 0.1), (False, 2, True, 0.3), (False, 3, False, 0.29), (True, 3, True, 1.0)], "q boolean, n int, ok boolean, s double")
    tiers = [r[0] for r in df.select(classify_tier(F.col("q"), F.col("n"), 3, F.col("ok"), F.col("s"))).collect()]
    assert tiers == ["gold", "silver", "tail", "non_speech"]
    said = spark.createDataFrame([(["", None, "x"], [0.0, None, 0.1]), (["a", "b", ""], [0.6, None, 0.0]), (["a", "b", "c"], [0.61, 0.0, 0.0])], "t array<string>, p array<double>")
    assert [r[0] for r in said.select(is_non_speech(F.col("t"), F.col("p"))).collect()] == [True, False, True]
    c = spark.createDataFrame([(0.4, 0.8, None), (0.4, 0.8, 0.7)], "a double, r double, d double").select(confidence_score(F.col("a"), F.col("r"), F.col("d"))).collect()
    assert [r[0] for r in c] == pytest.approx([0.6, 0.5])


def stack_replay(events):
    out = {}
    for key, seq, action, decision in sorted(events, key=lambda e: e[1]):
        stack = out.setdefault(key, [])
        if action == "set":
            stack.append((seq, decision))
        elif stack:
            stack.pop()
    return {k: s[-1] for k, s in out.items() if s}


def test_replay_against_a_stack(spark):
    rng = random.Random(5)
    events = [(f"k{rng.randrange(60)}", i, rng.choice(["set", "set", "undo", "other"]), rng.choice(["accept", "edit"])) for i in range(1500)]
    events += [("end", 5000, "set", "accept"), ("end", 5001, "undo", None), ("start", 5002, "undo", None), ("start", 5003, "set", "edit")]
    rng.shuffle(events)
    got = replay(spark.createDataFrame(events, "utterance_id string, seq long, action string, decision string"))
    assert {r["utterance_id"]: (r["seq"], r["decision"]) for r in got.collect()} == stack_replay(events)
    assert review_offset(got.filter("false")).first()[0] == 0


LABEL = "utterance_id string, shard int, pos long, transcript string, tier string, rover_confidence double, agreement_score double, n_models_agree long, callsign_matched boolean, callsign_tail string, advisory_disagree double"


def label(i, tier="silver", score=0.5, disagree=None, shard=0):
    return (f"u{i:04d}", shard, i, f"text {i}", tier, 0.8, score, 2, True, None, disagree)


def test_effective_published_training(spark):
    labels = spark.createDataFrame([label(0), label(1), label(2), label(3, "tail"), label(4, "gold")], LABEL)
    said = [("u0000", "accept", None), ("u0001", "edit", "fixed"), ("u0002", "reject", "x"), ("u0003", "non_speech", None)]
    rows = effective(labels, spark.createDataFrame(said, "utterance_id string, decision string, transcript string"))
    got = {r["utterance_id"]: r for r in rows.collect()}
    assert [got[f"u000{i}"]["effective_transcript"] for i in range(5)] == ["text 0", "fixed", "", "", "text 4"]
    assert [got[f"u000{i}"]["source"] for i in range(5)] == ["human-confirmed", "human", "human", "human", "model"]
    out = {r["utterance_id"]: r for r in published(rows).collect()}
    assert [out[f"u000{i}"]["review_status"] for i in range(5)] == ["verified", "edited", "rejected", "non_speech", "auto"]
    assert [out[f"u000{i}"]["confidence"] for i in range(5)] == pytest.approx([1, 1, 0, 1, 0.65])
    assert published(rows.withColumn("confidence", F.lit(0.42))).filter("review_status = 'auto'").first()["confidence"] == 0.42
    assert {r["utterance_id"] for r in training_rows(rows).collect()} == {"u0000", "u0001", "u0004"}
    with pytest.raises(Exception, match="unknown decision"):
        published(rows.withColumn("review_decision", F.lit("correct"))).collect()


def plan_model(rows, budget, rank):
    pool = [r for r in rows if r["tier"] != "non_speech"]
    by_rank = lambda rs: sorted(rs, key=lambda r: (rank(r["utterance_id"]), r["utterance_id"]))
    gold = [r for r in by_rank(r for r in pool if r["tier"] == "gold")[:50] if not r["reviewed"]]
    bins = [by_rank(r for r in pool if min(9, max(0, int(r["agreement_score"] * 10))) == b) for b in range(10)]
    cal, turn = [], 0
    while len(cal) < budget // 2 and any(turn < len(b) for b in bins):
        for b in bins:
            if turn < len(b) and len(cal) < budget // 2:
                cal.append(b[turn])
        turn += 1
    cal = [r for r in cal if r not in gold]
    edge = [r for r in pool if r not in gold and r not in cal]
    edge = [r for r in edge if abs(r["agreement_score"] - 0.3) <= 0.1 or (r["tier"] in ("gold", "silver") and (r["advisory_disagree"] or 0.0) >= 0.5)]
    edge.sort(key=lambda r: (abs(r["agreement_score"] - 0.3), -(r["advisory_disagree"] or 0.0), rank(r["utterance_id"]), r["utterance_id"]))
    edge = edge[: budget - len(cal)]
    mixed = []
    for i in range(max(len(edge), len(cal))):
        mixed += [("boundary", r) for r in edge[i : i + 1]] + [("calibration", r) for r in cal[i : i + 1]]
    return [("gold-validation", r["utterance_id"]) for r in gold] + [(k, r["utterance_id"]) for k, r in mixed]


@pytest.mark.parametrize("budget", [0, 7, 120, 1000])
def test_plan_against_a_loop(spark, budget):
    import hashlib

    rng = random.Random(budget)
    rows = [label(i, rng.choice(["gold", "silver", "tail", "non_speech"]), rng.random(), rng.choice([None, rng.random()])) for i in range(400)]
    reviewed = spark.createDataFrame([(f"u{i:04d}",) for i in range(0, 400, 9)], "utterance_id string")
    flagged = flag_reviewed(spark.createDataFrame(rows, LABEL), reviewed)
    got = [(r["reason"], r["utterance_id"]) for r in review_plan(flagged, budget, md5_rank).orderBy("position").collect()]
    assert got == plan_model([r.asDict() for r in flagged.collect()], budget, lambda i: hashlib.md5(i.encode()).hexdigest())


def test_queue_and_counts(spark):
    rows = [label(0, disagree=0.1), label(1, "tail", 0.2), label(2, "gold"), label(3, disagree=0.9, shard=1), label(4, score=0.4, disagree=0.1)]
    flagged = flag_reviewed(spark.createDataFrame(rows, LABEL), spark.createDataFrame([("u0001",), ("u0002",)], "utterance_id string"))
    assert [r["utterance_id"] for r in review_queue(flagged).orderBy("position").collect()] == ["u0004", "u0000", "u0001", "u0003"]
    got = queue_counts(flagged).first()
    assert (got["total"], got["reviewed"], got["remaining"], got["silver_total"], got["tail_reviewed"]) == (4, 1, 3, 3, 1)
    empty = queue_counts(flagged.filter("false")).first()
    assert (empty["total"], empty["silver_total"]) == (0, 0)


def test_snapshot_digest_follows_content_only(spark):
    labels = spark.createDataFrame([label(0), label(1, shard=1)], LABEL)
    none = spark.createDataFrame([], "utterance_id string, decision string, transcript string")
    events = spark.createDataFrame([("u", 4)], "utterance_id string, seq long")
    take = lambda rows, ts: snapshot(rows, events, "s", ts).first()
    a, b = take(effective(labels, none), 1.0), take(effective(labels, none), 2.0)
    edited = take(effective(labels, spark.createDataFrame([("u0000", "edit", "new")], none.schema)), 1.0)
    assert a["digest"] == b["digest"] != edited["digest"] and a["review_offset"] == 5 and a["total"] == 2
    assert a["shards"].keys() == {"shard-00000", "shard-00001"} and a["by_tier"] == {"silver": 2} and a["shards"]["shard-00001"] == edited["shards"]["shard-00001"]


def test_window_keys_and_tracks(spark):
    rows = spark.createDataFrame([("k", 1), ("k", 2), ("k", 5), ("j", 2)], "p string, n long")
    got = {(r["p"], r["n"]): r["conversation"] for r in conversation_window(rows, "p", "n", F.col("n")).collect()}
    assert got == {("k", 1): [1, 2], ("k", 2): [1, 2, 5], ("k", 5): [2, 5], ("j", 2): [2]}
    prefix, position = split_key(F.col("u"))
    keys = spark.createDataFrame([("a/b/12",), ("a/x",), ("7",)], "u string").select(prefix.alias("p"), position.alias("n")).collect()
    assert [tuple(r) for r in keys] == [("a/b", 12), ("a", None), ("", 7)]
    kind = "tracks array<struct<t:timestamp_ntz,tail:string,aircraft_id:string,lat:double,lon:double,alt:int,speed:int,heading:int>>"
    from datetime import datetime

    at = lambda s: datetime(2024, 1, 1, 0, 0, s)
    points = [(at(5), "N1", "x", 1.0, 1.0, 1, 1, 1), (None, "N1", "x", None, 1.0, 2, 1, 1), (at(1), None, None, 1.0, 1.0, 3, 1, 1), (at(2), "N1", "x", 1.0, 1.0, 4, 1, 1), (at(1), "N2", "", 1.0, 1.0, 5, 1, 1)]
    df = spark.createDataFrame([(points,), ([],), (None,)], kind).select(group_tracks(F.col("tracks")).alias("g"))
    got = [r["g"] for r in df.collect()]
    assert [[p["alt"] for p in t["points"]] for t in got[0]] == [[4, 1, 2], [3], [5]] and got[1] == got[2] == []
    assert df.select(map_points(F.col("g"))[0]["marker"]["alt"]).first()[0] == 1
    said = spark.createDataFrame([("accept",), ("edit",), ("reject",)], "d string").select(decided_transcript(F.col("d"), F.lit("base"), F.lit("draft"))).collect()
    assert [r[0] for r in said] == ["base", "draft", ""]


def test_tables(spark):
    meta = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "utterance_id string, shard int")
    hyps = spark.createDataFrame([("a", "m1", "x", 0.1), ("a", "m2", None, None), ("b", "m1", "y", 0.2), ("c", "m1", "z", 0.3), ("c", "m2", "z", 0.3), ("c", "adv", "w", 0.0)], "utterance_id string, model string, text string, no_speech double")
    got = join_voters(meta, hyps, ["m2", "m1"], advisory="adv")
    rows = {r["utterance_id"]: r for r in got.collect()}
    assert rows.keys() == {"a", "c"} and [v["text"] for v in rows["a"]["voting"]] == ["", "x"] and rows["a"]["advisory"] is None and rows["c"]["advisory"]["text"] == "w"
    assert {tuple(r) for r in shard_counts(meta, got).collect()} == {(0, 1, 1), (1, 1, 0)}
    last = last_wins(spark.createDataFrame([("k", 1, "a"), ("k", 5, "b"), ("j", 3, None)], "k string, pos int, v string"), ["k"])
    assert {tuple(r) for r in last.select("k", "pos", "v").collect()} == {("k", 1, "b"), ("j", 3, None)}
    assert [r[0] for r in pending(meta, spark.createDataFrame([(0,)], "shard int")).collect()] == [1]
    clips = spark.createDataFrame([(i, float(-i)) for i in range(10)], "i int, d double")
    assert {r["bucket"]: {x["i"] for x in duration_buckets(clips, "d", 4).collect() if x["bucket"] == r["bucket"]} for r in [{"bucket": b} for b in range(3)]} == {0: {9, 8, 7, 6}, 1: {5, 4, 3, 2}, 2: {1, 0}}


def test_numbered_over_partitions(spark):
    df = spark.range(1000).repartition(7).withColumn("x", (F.col("id") * 37) % 1000)
    got = numbered(df, F.col("x").desc()).collect()
    assert all(r["position"] == 1000 - r["x"] for r in got)
