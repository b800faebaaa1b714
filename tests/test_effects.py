"""The log of effects, calls in flight, and corrections that resume."""

import json
import time
from threading import Lock

import pytest

from quillon.plans.calls import Calls, in_order, patient
from quillon.plans.stages import run_corrections
from quillon.schemas import LABELS, META
from quillon.sinks.effects import EffectLog
from quillon.sources.shards import file_system

from .test_stages import _lab


def label_rows(n, shards=2):
    rows = [(*_lab(f"u{i}", "gold" if i % 4 == 3 else "silver", f"text number {i}"), i % shards, i) for i in range(n)]
    return rows, f"{LABELS}, shard int, pos long"


def model(asked, fail_at=None, reply="Right text!"):
    """A factory of functions that write each prompt they answer to a file, and fail on the one that names fail_at."""

    def make():
        def ask(prompt, grammar):
            said = prompt.splitlines()[-3]
            if fail_at is not None and said.endswith(fail_at):
                raise RuntimeError("the server is gone")
            with open(asked, "a") as f:
                f.write(said + "\n")
            return reply

        return ask

    return make


def test_a_broken_run_asks_nothing_twice(spark, tmp_path):
    rows, schema = label_rows(40)
    labels, meta = spark.createDataFrame(rows, schema).repartition(4), spark.createDataFrame([], META)
    asked, out = str(tmp_path / "asked"), str(tmp_path / "out")
    silver = [r[0][1:] for r in rows if r[2] == "silver"]
    with pytest.raises(Exception, match="server is gone"):
        run_corrections(labels, meta, model(asked, fail_at="three eight"), out, Calls(retries=0, in_flight=2))
    before = open(asked).read().splitlines()
    assert 0 < len(before) < len(silver) and not (tmp_path / "out").exists()
    assert {r["answer"] for r in EffectLog(f"{out}.answers").answers(spark).collect()} == {"Right text!"}
    assert EffectLog(f"{out}.answers").answers(spark).count() == len(before)
    told = {r["shard"]: (r["rows"], r["corrected"]) for r in run_corrections(labels, meta, model(asked), out).collect()}
    assert sorted(open(asked).read().splitlines()) == sorted(set(open(asked).read().splitlines())) and len(open(asked).readlines()) == len(silver)
    got = spark.read.parquet(out).collect()
    recount = {s: (sum(r["shard"] == s for r in got), sum(r["shard"] == s and r["corrected"] for r in got)) for s in (0, 1)}
    assert told == recount and sum(n for n, _ in told.values()) == 40 and sum(c for _, c in told.values()) == len(silver)
    assert not (tmp_path / "out.answers").exists()
    assert run_corrections(labels, meta, model(asked), out).count() == 0 and len(open(asked).readlines()) == len(silver)


def test_torn_tail_is_asked_again_and_a_whole_log_is_promoted(spark, tmp_path):
    rows, schema = label_rows(6, shards=1)
    labels, meta = spark.createDataFrame(rows, schema), spark.createDataFrame([], META)
    out, asked = str(tmp_path / "out"), str(tmp_path / "asked")
    line = lambda i, at, text="bravo": json.dumps({"shard": 0, "utterance_id": f"u{i}", "answer": text, "at": at}) + "\n"
    (tmp_path / "out.answers").mkdir()
    (tmp_path / "out.answers/a-0.jsonl").write_text(line(0, 5) + line(1, 6) + '{"shard": 0, "utterance_id": "u2", "ans')
    (tmp_path / "out.answers/b-0.jsonl").write_text(line(0, 4, "the first") + line(0, 9, "late"))  # other attempts
    told = run_corrections(labels, meta, model(asked), out, tasks=2).collect()
    assert [tuple(r) for r in told] == [(0, 6, 5)] and len(open(asked).readlines()) == 3
    got = {r["utterance_id"]: r["transcript"] for r in spark.read.parquet(out).collect()}
    assert (got["u0"], got["u1"], got["u2"], got["u3"]) == ("the first", "bravo", "right text", "text number 3")
    again = str(tmp_path / "again")
    (tmp_path / "again.answers").mkdir()
    (tmp_path / "again.answers/a-0.jsonl").write_text("".join(line(i, i) for i in (0, 1, 2, 4, 5)))
    assert run_corrections(labels, meta, model(asked), again).first()["corrected"] == 5 and len(open(asked).readlines()) == 3
    (tmp_path / "bad.answers").mkdir()
    (tmp_path / "bad.answers/a-0.jsonl").write_text('{"shard": 0,\n' + line(1, 1))
    with pytest.raises(Exception, match="is no JSON"):
        run_corrections(labels, meta, model(asked), str(tmp_path / "bad"))


def test_only_shards_without_output_are_corrected(spark, tmp_path):
    rows, schema = label_rows(9, shards=3)
    labels, meta = spark.createDataFrame(rows, schema), spark.createDataFrame([], META)
    out, asked = str(tmp_path / "out"), str(tmp_path / "asked")
    assert run_corrections(labels.filter("shard = 1"), meta, model(asked), out).count() == 1
    first = len(open(asked).readlines())
    assert {r["shard"] for r in run_corrections(labels, meta, model(asked, reply=""), out).collect()} == {0, 2}
    assert len(open(asked).readlines()) == sum(r[2] == "silver" for r in rows) and first > 0
    kept = {r["utterance_id"]: r for r in spark.read.parquet(out).collect()}
    assert len(kept) == 9 and kept["u1"]["transcript"] == "right text" and kept["u0"]["transcript"] == "text number zero"  # a blank answer changes nothing
    assert run_corrections(labels.limit(0), meta, model(asked), str(tmp_path / "none")).count() == 0


def test_failed_calls_as_told(spark, tmp_path):
    rows, schema = label_rows(8, shards=1)
    labels, meta = spark.createDataFrame(rows, schema), spark.createDataFrame([], META)
    told = run_corrections(labels, meta, model(str(tmp_path / "asked"), fail_at="five"), str(tmp_path / "out"), Calls(retries=0, on_failure="none")).first()
    assert (told["rows"], told["corrected"]) == (8, 5)
    with pytest.raises(ValueError):
        Calls(on_failure="ignore")


def test_segments_and_paths(spark, tmp_path):
    log = EffectLog(f"file:{tmp_path}/log", segment_rows=3)
    with log.writer() as one, log.writer() as two:
        for i in range(7):
            one.put(1, f"é{i}", f"a\n{i}")
        two.put(1, "é0", "late")
    assert len(list((tmp_path / "log").iterdir())) == 4 and log.rows(spark).count() == 8
    assert {(r["utterance_id"], r["answer"]) for r in log.answers(spark).collect()} == {(f"é{i}", f"a\n{i}") for i in range(7)}
    log.clear(spark)
    log.clear(spark)
    assert log.rows(spark).count() == 0 and file_system("/a/b")[1] == file_system("file:///a/b")[1] == file_system("file:/a/b")[1] == "/a/b"


def test_calls_in_flight():
    most, now, lock = [0], [0], Lock()

    def slow(i):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.05)
        with lock:
            now[0] -= 1
        return i

    start = time.time()
    assert list(in_order(range(80), slow, 8)) == list(range(80))
    assert time.time() - start < 0.2 * 80 * 0.05 and most[0] == 8
    tries = []

    def shaky(i):
        tries.append(i)
        if i == 3 and tries.count(3) < 3:
            raise OSError("busy")
        return i

    assert list(in_order(range(6), patient(shaky, Calls(retries=2, pause=0.001)), 2)) == list(range(6)) and tries.count(3) == 3
    begun = []
    with pytest.raises(OSError):
        list(in_order(range(1000), lambda i: begun.append(i) or patient(shaky, Calls(retries=0))(3 if i == 5 and not tries.clear() else i), 2))
    assert len(begun) < 20
    assert patient(lambda: 1 / 0, Calls(retries=1, pause=0.001, on_failure="none"))() is None
