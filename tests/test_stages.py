import json
import os

import pytest
from pyspark.sql import functions as F

from quillon.plans.stages import correct, correction_prompt, fuse, transcribe, transcript_grammar
from quillon.plans.studio import Studio
from quillon.schemas import LABELS, META, REVIEWS
from quillon.sinks.files import append_rows, done_shards, fill_card, publish_shards, write_jsonl, write_pending
from quillon.sources.catalog import ModelSpec, check_weights, choose, factory_of, load_specs, register_kind
from quillon.sources.jsonl import read_jsonl, read_jsonl_recoverable, read_shards
from quillon.sources.parquet import clips, meta_rows, read_source
from quillon.sources.shards import comma_list, list_shards, parse_shard_spec
from quillon.streaming.replay import stream_verdicts

from .test_functions import wav


def test_specs_lists_catalogue(spark, tmp_path):
    assert parse_shard_spec("0-2, 7,1-3,,") == [0, 1, 2, 3, 7] and comma_list(" a, ,b") == ["a", "b"]
    for name in ("shard-00003.parquet", "shard-00001.jsonl", "other"):
        (tmp_path / name).write_text("{}")
    assert [r[0] for r in list_shards(spark, str(tmp_path)).collect()] == [1, 3] and list_shards(spark, f"{tmp_path}/no").count() == 0
    (tmp_path / "m.toml").write_text('[models.one]\nkind = "fake"\nref = "r"\nbeam = 4\n')
    (tmp_path / "n.toml").write_text("")
    specs = load_specs(str(tmp_path / "m.toml"))
    assert specs["one"] == ModelSpec("one", "fake", "r", {"beam": 4}) and load_specs(str(tmp_path / "n.toml")) == {}
    with pytest.raises(ValueError):
        choose(specs, ["two"])
    with pytest.raises(ValueError):
        factory_of(ModelSpec("x", "none", "r"))
    with pytest.raises(ValueError):
        check_weights(["a", "b"], [1.0])


def test_jsonl(spark, tmp_path):
    (tmp_path / "shard-00002.jsonl").write_text('{"a":1}\n\n{"a":2,"zz":0}\n')
    assert sorted(r["a"] for r in read_jsonl(spark, str(tmp_path / "shard-00002.jsonl"), "a long").collect()) == [1, 2]
    assert {tuple(r) for r in read_shards(spark, str(tmp_path), "a long").collect()} == {(1, 2), (2, 2)}
    assert read_shards(spark, f"{tmp_path}/none", "a long").count() == 0
    (tmp_path / "torn.jsonl").write_text('{"a":1}\n{"a":2}\n{"a":')
    assert [r["a"] for r in read_jsonl_recoverable(spark, str(tmp_path / "torn.jsonl"), "a long").orderBy("pos").collect()] == [1, 2]
    (tmp_path / "bad.jsonl").write_text('{"a":1}\n{"a":\n{"a":3}\n')
    with pytest.raises(Exception, match="is no JSON"):
        read_jsonl_recoverable(spark, str(tmp_path / "bad.jsonl"), "a long").collect()
    assert read_jsonl_recoverable(spark, str(tmp_path / "no.jsonl"), "a long").count() == 0
    (tmp_path / "strict.jsonl").write_text('{"a":1}\n{"a":\n')
    with pytest.raises(Exception, match="[Mm]alformed|FAILFAST"):
        read_jsonl(spark, str(tmp_path / "strict.jsonl"), "a long").collect()


class Echo:
    def __init__(self, spec):
        self.name = spec.name

    def transcribe(self, rows):
        return [{"text": f"{self.name} {r['utterance_id']} {len(r['audio']['samples'])}", "no_speech": 0.1} for r in rows]


def test_source_and_transcribe(spark, tmp_path):
    rows = [(f"s/{i}", "kxyz", ["N1", "", None] if i else None, (bytearray(wav([0.1] * 100 * (i + 1))), "p"), float(i)) for i in range(3)]
    frame = spark.createDataFrame(rows, "utterance_id string, airport string, tails array<string>, audio struct<bytes:binary,path:string>, duration_s double")
    frame.coalesce(1).write.parquet(str(tmp_path / "t"))
    part = next(p for p in (tmp_path / "t").iterdir() if p.name.endswith(".parquet"))
    os.rename(part, tmp_path / "shard-00004.parquet")
    src = read_source(spark, str(tmp_path), [4])
    assert read_source(spark, str(tmp_path), [5]).count() == 0 and src.filter("tracks is null and n_aircraft is null").count() == 3
    assert [r["tails"] for r in meta_rows(src).orderBy("pos").collect()] == [[], ["N1"], ["N1"]]
    register_kind("echo", Echo)
    got = {r["utterance_id"]: r for r in transcribe(clips(src), ModelSpec("m", "echo", "")).collect()}
    assert got["s/1"]["text"] == "m s/1 1600" and got["s/0"]["shard"] == 4 and got["s/0"]["confidence"] is None


def hyps(*rows):
    return [(u, m, t, p) for u, m, t, p in rows]


def test_fuse(spark):
    meta = spark.createDataFrame([("u0", 0, "k", ["N172SP"]), ("u1", 0, "k", []), ("u2", 0, "k", []), ("u3", 0, "k", [])], "utterance_id string, shard int, airport string, tails array<string>")
    said = "november one seven two sierra papa descend"
    rows = [("u0", 0, m, said, 0.0) for m in "abc"] + [("u1", 0, m, t, 0.0) for m, t in zip("abc", ("", "", "hello"), strict=True)]
    rows += [("u2", 0, m, t, 0.0) for m, t in zip("abc", ("a b c d e f", "a b c d e x", "a b c d y x"), strict=True)] + [("u3", 0, "a", "only", 0.0)]
    rows += [("u0", 0, "adv", "something else", 0.9)]
    got = {r["utterance_id"]: r for r in fuse(meta, spark.createDataFrame(rows, "utterance_id string, shard int, model string, text string, no_speech double"), list("abc"), advisory="adv").collect()}
    assert got.keys() == {"u0", "u1", "u2"}
    assert (got["u0"]["tier"], got["u0"]["transcript"], got["u0"]["n_models_agree"]) == ("gold", said, 3) and got["u0"]["advisory_disagree"] == 1.0
    assert got["u0"]["confidence"] == pytest.approx(2 / 3) and (got["u1"]["tier"], got["u1"]["transcript"]) == ("non_speech", "") and got["u2"]["tier"] == "silver"


def test_prompt_and_grammar(spark):
    df = spark.createDataFrame([(["Hi 2"], "Hi two.", ["N1", "N1"]), (None, "x", [])], "v array<string>, t string, tails array<string>")
    rows = df.select(correction_prompt(F.col("v"), F.col("t"), F.col("tails"), "DO").alias("p"), transcript_grammar(F.col("tails")).alias("g")).collect()
    assert rows[0]["p"].split("\n")[2:] == ["", "CALLSIGNS", "- november one", "", "CANDIDATES", "1. hi two", "", "CONSENSUS", "hi two", "", "CORRECTED"]
    assert rows[1]["p"] == "DO\n\nCANDIDATES\n\nCONSENSUS\nx\n\nCORRECTED" and rows[1]["g"] is None
    assert rows[0]["g"].splitlines()[1] == 'callsign ::= "november one"'


def _lab(u, tier, text, tail=None, matched=False):
    return (u, text, tier, 0.5, 0.5, 0.5, 2, 0, matched, tail, 0.0, False, [text], None)


def test_correct_asks_silver_only_and_resumes(spark, tmp_path):
    labels = spark.createDataFrame([_lab("g", "gold", "keep"), _lab("s", "silver", "wrong text"), _lab("d", "silver", "done before"), _lab("c", "silver", "november one seven two sierra hotel", "N172SP", True)], LABELS)
    meta = spark.createDataFrame([("s", "k", []), ("c", "k", ["N172SP"])], META)
    log = str(tmp_path / "asked")

    def make():
        def ask(prompt, grammar):
            with open(log, "a") as f:
                f.write(json.dumps([prompt[-40:], grammar is not None]) + "\n")
            return "November one seven two sierra hotel descend" if grammar else "Right text!"

        return ask

    done = spark.createDataFrame([("d", "from the log", True, False)], "utterance_id string, transcript string, corrected boolean, callsign_enforced boolean")
    got = {r["utterance_id"]: r for r in correct(labels, meta, make, done).collect()}
    assert len(open(log).readlines()) == 2 and len(got) == 4
    assert (got["g"]["transcript"], got["g"]["corrected"]) == ("keep", False) and (got["s"]["transcript"], got["s"]["corrected"]) == ("right text", True)
    assert got["d"]["transcript"] == "from the log" and got["c"]["callsign_enforced"] and "november one seven two sierra papa" in got["c"]["transcript"]


def test_publish_and_resume(spark, tmp_path):
    rows = spark.createDataFrame([(s, p, f"u{s}{p}") for s in (0, 12) for p in range(50)], "shard int, pos long, utterance_id string").repartition(5)
    assert publish_shards(rows, str(tmp_path / "out"), "n __N_ROWS__ in __N_SHARDS__") == (2, 100)
    names = sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith("."))
    assert names == ["README.md", "shard-00000.parquet", "shard-00012.parquet"] and (tmp_path / "out/README.md").read_text() == "n 100 in 2"
    import pyarrow.parquet as pq

    assert pq.read_table(str(tmp_path / "out/shard-00012.parquet")).column("utterance_id").to_pylist() == [f"u12{p}" for p in range(50)]
    assert fill_card("__N_ROWS__", 531000, 1) == "531,000"
    stage = str(tmp_path / "stage")
    write_pending(rows.filter("shard = 0"), stage)
    write_pending(rows.withColumn("utterance_id", F.lit("new")), stage)
    assert sorted(r[0] for r in done_shards(spark, stage).collect()) == [0, 12]
    assert spark.read.parquet(stage).filter("utterance_id = 'new'").select("shard").distinct().collect()[0][0] == 12
    assert write_jsonl(rows, str(tmp_path / "j")) == 100


def test_stage_by_model_and_shard(spark, tmp_path):
    rows = spark.createDataFrame([(s, p, f"u{s}{p}") for s in (0, 12) for p in range(3)], "shard int, pos long, utterance_id string")
    stage, by = str(tmp_path / "stage"), ("model", "shard")
    assert done_shards(spark, stage, by).count() == 0
    write_pending(rows.withColumn("model", F.lit("org/a b=c")), stage, by)
    write_pending(rows.filter("shard = 0").withColumn("model", F.lit("second")), stage, by)
    write_pending(rows.withColumns({"model": F.lit("second"), "utterance_id": F.lit("new")}), stage, by)
    assert sorted(map(tuple, done_shards(spark, stage, by).collect())) == [("org/a b=c", 0), ("org/a b=c", 12), ("second", 0), ("second", 12)]
    kept = spark.read.parquet(stage)
    assert kept.count() == 12 and sorted(r[0] for r in kept.filter("utterance_id = 'new'").select("shard").collect()) == [12] * 3
    assert kept.filter("model = 'org/a b=c'").count() == 6


def test_studio(spark, tmp_path):
    labels = spark.createDataFrame([(*_lab(f"kagc/{i}", "silver" if i % 2 else "gold", f"text {i}"), 0, i) for i in range(1, 7)], f"{LABELS}, shard int, pos long")
    meta = spark.createDataFrame([(f"kagc/{i}", "k", ["N1"]) for i in range(1, 7)], META)
    desk = Studio(labels, meta, spark.createDataFrame([], REVIEWS), folder=str(tmp_path / "reviews"), reviewer="r")
    assert desk.queue().count() == 3 and desk.stats().first()["remaining"] == 3 and desk.plan().count() == 6
    with pytest.raises(ValueError):
        desk.record("kagc/1", "correct", "", "")
    with pytest.raises(KeyError):
        desk.record("nobody", "accept", "", "")
    assert desk.record("kagc/1", "accept", "text 1", "text 1")["seq"] == 0 and desk.record("kagc/1", "edit", "better", "text 1")["seq"] == 1
    one = desk.context("kagc/1").first()
    assert one["effective_transcript"] == "better" and [c["utterance_id"] for c in one["conversation"]] == [f"kagc/{i}" for i in range(1, 5)]
    assert [c["current"] for c in one["conversation"]] == [True, False, False, False] and [o["op"] for o in one["aligned_hypotheses"][0]["ops"]] == ["equal", "equal"]
    assert desk.undo("kagc/1")["decision"] == "accept" and desk.undo("kagc/1") is None and desk.undo("kagc/1") is None
    assert read_jsonl(spark, str(tmp_path / "reviews"), REVIEWS).count() == 4 and desk.context("nobody").count() == 0
    with pytest.raises(KeyError):
        desk.audio("kagc/1")


def test_three_counts_of_reviewed(spark):
    labels = spark.createDataFrame([(*_lab(f"kagc/{i}", "silver" if i % 2 else "gold", f"text {i}"), 0, i) for i in range(1, 7)], f"{LABELS}, shard int, pos long")
    desk = Studio(labels, spark.createDataFrame([], META), spark.createDataFrame([], REVIEWS))
    assert tuple(desk.queue_totals().first()) == (3, 0) and tuple(desk.plan_totals().first()) == (6, 0)
    for key in ("kagc/1", "kagc/2"):
        desk.record(key, "accept", "", "")
    assert tuple(desk.queue_totals().first()) == (3, 2) and desk.stats().first()["reviewed"] == 1
    items = desk.plan().collect()
    assert tuple(desk.plan_totals().first()) == (len(items), sum(r["reviewed"] for r in items))


def test_streamed_verdicts(spark, tmp_path):
    folder, out = str(tmp_path / "in"), []
    batch = lambda rows: append_rows(spark.createDataFrame(rows, "utterance_id string, seq long, action string, decision string, transcript string").coalesce(1), folder)
    batch([("a", 1, "set", "accept", None), ("a", 2, "set", "edit", "x"), ("b", 3, "undo", None, None)])
    stream = spark.readStream.schema("utterance_id string, seq long, action string, decision string, transcript string").json(folder)
    run = stream_verdicts(stream).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "c")).foreachBatch(lambda df, i: out.append({r["utterance_id"]: r for r in df.collect()})).start()
    run.processAllAvailable()
    batch([("a", 4, "undo", None, None)])
    run.processAllAvailable()
    run.stop()
    assert out[0]["a"]["decision"] == "edit" and out[0]["b"]["depth"] == 0 and out[-1]["a"]["decision"] == "accept"
