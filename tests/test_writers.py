"""Writers of datasets, training rows and snapshots; models that fail; pages of the queue."""

import json

import pytest
from pyspark.sql import functions as F

from quillon.operators.review import effective, replay
from quillon.plans.stages import run_transcriptions
from quillon.plans.studio import Studio
from quillon.schemas import LABELS, META, REVIEWS
from quillon.sinks.files import done_shards, publish_shards, write_dataset, write_snapshot, write_trainset
from quillon.sources.catalog import ModelSpec, register_kind

from .test_stages import Echo, _lab


@pytest.fixture(scope="module")
def desk(spark):
    rows = [(*_lab(f"kagc/{i}", ("gold", "silver", "tail")[i % 3], f"téxt {i} 😀"), i % 2, i) for i in range(12)]
    labels = spark.createDataFrame(rows, f"{LABELS}, shard int, pos long").repartition(4)
    events = spark.createDataFrame([("kagc/1", "set", 0, 0.0, 1, None, "edit", "better", ""), ("kagc/2", "set", 1, 0.0, 0, None, "reject", "", "")], REVIEWS)
    return labels, events


def test_datasets_are_lines_of_a_plain_serialiser(spark, desk, tmp_path):
    labels, events = desk
    rows = effective(labels, replay(events))
    assert write_dataset(rows, f"{tmp_path}/data") == (2, 12) == write_dataset(rows, f"{tmp_path}/data")
    lines = (tmp_path / "data/shard-00001.jsonl").read_text().splitlines()
    read = [json.loads(line) for line in lines]
    assert [r["utterance_id"] for r in read] == [f"kagc/{i}" for i in range(1, 12, 2)] and lines == [json.dumps(r) for r in read]
    assert list(read[0]) == [
        "utterance_id", "transcript", "confidence", "review_status", "agreement_score", "rover_confidence", "advisory_disagree", "n_models_agree", "callsign_matched", "callsign_tail"
    ]
    assert (read[0]["transcript"], read[0]["review_status"], read[0]["confidence"]) == ("better", "edited", 1.0) and read[1]["transcript"] == "téxt 3 😀"
    assert write_trainset(rows, f"{tmp_path}/train") == (2, 8)  # of 12, the silver, gold and edited ones; 2 is rejected, others are of the tail
    assert write_trainset(rows, f"{tmp_path}/gold", ("gold",))[1] == 5
    assert write_dataset(rows.limit(0), f"{tmp_path}/none") == (0, 0)
    with pytest.raises(ValueError):
        publish_shards(rows, f"{tmp_path}/x", form="csv")


def test_snapshot_file(spark, desk, tmp_path):
    labels, events = desk
    rows = effective(labels, replay(events))
    path = write_snapshot(rows, events, str(tmp_path / "snapshots"), "first", ts=5.0, tiers=["gold"])
    told = json.loads((tmp_path / "snapshots/first.json").read_text())
    assert path.endswith("first.json") and list(told) == ["name", "ts", "review_offset", "digest", "shards", "total", "by_tier", "tiers"]
    assert (told["review_offset"], told["total"], told["by_tier"], told["tiers"]) == (2, 12, {"gold": 4, "silver": 4, "tail": 4}, ["gold"]) and set(told["shards"]) == {"shard-00000", "shard-00001"}
    write_snapshot(rows, events, str(tmp_path / "snapshots"), "first", ts=6.0)
    again = json.loads((tmp_path / "snapshots/first.json").read_text())
    assert (again["ts"], again["tiers"], again["digest"]) == (6.0, None, told["digest"])
    with pytest.raises(ValueError):
        write_snapshot(rows, events, str(tmp_path), "a/b")


class Broken(Echo):
    def transcribe(self, rows):
        raise RuntimeError("no memory on the card")


def test_a_model_that_fails_does_not_stop_the_others(spark, tmp_path):
    register_kind("echo", Echo)
    register_kind("broken", Broken)
    clips = spark.range(8).select(
        F.concat(F.lit("u"), "id").alias("utterance_id"), (F.col("id") % 2).cast("int").alias("shard"), F.col("id").alias("pos"),
        F.struct(F.array(F.lit(0.1)).alias("samples"), F.lit(16000).alias("rate")).alias("audio"),
    )
    said, folder = [], str(tmp_path / "hyps")
    specs = [ModelSpec("a", "broken", ""), ModelSpec("b", "echo", "")]
    got = run_transcriptions(clips, specs, folder, log=said.append)
    assert "no memory" in got["a"] and got["b"] is None and said[0].startswith("a failed")
    assert sorted(map(tuple, done_shards(spark, folder, ("model", "shard")).collect())) == [("b", 0), ("b", 1)]
    more = clips.unionByName(clips.withColumns({"shard": F.lit(7), "utterance_id": F.lit("late")}))
    assert run_transcriptions(more, [ModelSpec("a", "echo", ""), specs[1]], folder, log=said.append) == {"a": None, "b": None}
    rows = spark.read.parquet(folder)
    assert rows.groupBy("model", "shard").count().count() == 6 and rows.filter("model = 'a' and shard = 1").first()["text"].startswith("a u")
    assert run_transcriptions(more, specs, folder, log=said.append) == {"a": None, "b": None} and said[-1].startswith("b: all")


def test_pages_are_stable_and_read_their_files_only(spark, tmp_path):
    labels = spark.createDataFrame([(*_lab(f"kagc/{i}", "silver", f"text {i}"), 0, i) for i in range(95)], f"{LABELS}, shard int, pos long")
    desk = Studio(labels, spark.createDataFrame([], META), spark.createDataFrame([], REVIEWS), folder=str(tmp_path / "log"))
    pages = str(tmp_path / "pages")
    desk.pin_queue(pages, page_rows=10)
    want = [r["utterance_id"] for r in desk.queue().orderBy("position").collect()]
    first = desk.page(pages, size=15).collect()
    desk.record(first[0]["utterance_id"], "accept", "", "")
    got, after = [], 0
    while page := desk.page(pages, after, 15).collect():
        got += page
        after = page[-1]["position"]
        desk.record(page[3]["utterance_id"], "reject", "", "") if after < 40 else None
    assert [r["utterance_id"] for r in got] == want and [r["position"] for r in got] == list(range(1, 96)) and got[0]["reviewed"] and not got[1]["reviewed"]
    plan = desk.page(pages, 30, 15)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_page" in plan
