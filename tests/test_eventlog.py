"""The event log of many writers, files that are replaced without a gap, and the desk's state between requests."""

import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from quillon.operators.review import replay, standing
from quillon.plans.studio import Studio
from quillon.schemas import LABELS, META, REVIEWS
from quillon.sinks.eventlog import EventLog
from quillon.sinks.files import create_only, publish_shards, write_text

from .test_stages import _lab

EVENT = {"action": "set", "ts": 0.0, "shard": 0, "reviewer": None, "decision": "accept", "transcript": None, "base_hyp": None}


def test_writers_at_once_lose_nothing_and_repeat_no_number(spark, tmp_path):
    folder, got, failed = f"file:{tmp_path}/log", [], []

    def write(name):
        try:
            log = EventLog(spark, folder)
            for i in range(25):
                got.append((log.append([EVENT | {"utterance_id": f"{name}/{i}/{k}"} for k in range(1 + i % 3)]), 1 + i % 3))
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=write, args=(n,)) for n in "abcd"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed
    rows = EventLog(spark, folder).read().orderBy("seq").collect()
    assert [r["seq"] for r in rows] == list(range(sum(n for _, n in got))) and len({r["utterance_id"] for r in rows}) == len(rows) == 4 * (9 + 2 * 8 + 3 * 8)
    assert sorted(s for first, n in got for s in range(first, first + n)) == [r["seq"] for r in rows]
    assert not [n for n in os.listdir(tmp_path / "log") if n.endswith(".new")]


def test_log_reads_the_end_only(spark, tmp_path):
    log = EventLog(spark, str(tmp_path / "log"))
    assert log.next_seq() == 0 and log.read().count() == 0
    for i in range(5):
        assert log.append([EVENT | {"utterance_id": f"é{i}"}, EVENT | {"utterance_id": "x\n"}]) == 2 * i
    (tmp_path / "log/other.jsonl").write_text("no segment")
    assert log.next_seq() == 10 and log.read(7).inputFiles() == [f"file://{tmp_path}/log/{n:019d}.jsonl" for n in (6, 8)]
    assert sorted(r["seq"] for r in log.read(7).collect()) == [7, 8, 9]
    with pytest.raises(ValueError):
        log.append([])
    with pytest.raises(PermissionError):
        log.append([EVENT], check=lambda seq: (_ for _ in ()).throw(PermissionError(seq)))
    assert create_only(spark, f"{tmp_path}/one", b"first") and not create_only(spark, f"{tmp_path}/one", b"second") and (tmp_path / "one").read_bytes() == b"first"


def test_a_reader_never_finds_a_gap(spark, tmp_path):
    name, seen, stop = str(tmp_path / "card.md"), set(), threading.Event()
    write_text(spark, name, "0" * 1000)

    def read():
        while not stop.is_set():
            with open(name) as f:
                seen.add(f.read())

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(1, 60):
        write_text(spark, name, str(i % 10) * 1000)
    stop.set()
    reader.join()
    assert seen <= {str(i) * 1000 for i in range(10)} and len(seen) > 1
    rows = spark.range(50).select(F.lit(3).alias("shard"), F.col("id").alias("pos"), F.col("id").cast("string").alias("utterance_id"))
    for _ in range(2):
        assert publish_shards(rows, str(tmp_path / "out")) == (1, 50)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 50


def events_at(rng, first, n, keys):
    return [EVENT | {"utterance_id": f"kagc/{rng.randrange(keys)}", "seq": first + i, "action": rng.choice(("set", "set", "undo")), "decision": rng.choice(("accept", "edit")), "transcript": f"t{first + i}"} for i in range(n)]


def test_what_stands_replays_as_the_whole_log(spark):
    rng, names = random.Random(1), [f.split()[0] for f in REVIEWS.split(", ")]
    rows = events_at(rng, 0, 1000, 30)
    frame = lambda some: spark.createDataFrame([tuple(r[c] for c in names) for r in some], REVIEWS)
    for cut in (0, 1, 500, 999, 1000):
        base = standing(frame(rows[:cut]))
        got = replay(base.unionByName(frame(rows[cut:])))
        assert {(r["utterance_id"], r["seq"]) for r in got.collect()} == {(r["utterance_id"], r["seq"]) for r in replay(frame(rows)).collect()}
    stacks = {}
    for r in rows:
        stack = stacks.setdefault(r["utterance_id"], [])
        stack.append(r["seq"]) if r["action"] == "set" else stack and stack.pop()
    assert {(r["utterance_id"], r["seq"]) for r in standing(frame(rows)).collect()} == {(k, s) for k, v in stacks.items() for s in v}


def test_desks_share_a_log_and_read_what_is_new(spark, tmp_path):
    labels = spark.createDataFrame([(*_lab(f"kagc/{i}", "silver", f"text {i}"), 0, i) for i in range(5)], f"{LABELS}, shard int, pos long")
    before = spark.createDataFrame([("kagc/4", "set", 7, 0.0, 0, None, "accept", "", "")], REVIEWS)
    one, two = (Studio(labels, spark.createDataFrame([], META), before, folder=str(tmp_path / "log"), reviewer=n) for n in "ab")
    rng = random.Random(2)
    one.log.append([EVENT | {"utterance_id": "kagc/0", "transcript": "first"}])
    assert {r["utterance_id"] for r in one.current().collect()} == {"kagc/0", "kagc/4"} and one.refresh() == 1
    reads, read = [], one.log.read
    one.log.read = lambda since=0: reads.append(since) or read(since)
    two.log.append(events_at(rng, 0, 50, 5))
    assert two.record("kagc/1", "edit", "new", "text 1")["seq"] == 51
    log = EventLog(spark, str(tmp_path / "log")).read().select(*before.columns)
    whole = replay(before.withColumn("seq", F.lit(-1).cast("long")).unionByName(log))
    plain = lambda df: {(r["utterance_id"], r["transcript"]) for r in df.collect()}
    assert plain(one.current()) == plain(two.current()) == plain(whole) and reads == [1] and one.refresh() == 52
    one.current()
    assert reads == [1]  # nothing new: the log is not read
    assert two.undo("kagc/1") != {"transcript": "new"} and one.undo("nobody") is None
