"""The pluggable source, rows paired by place, canonical JSON and streamed digests."""

import hashlib
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from quillon.operators.snapshot import canonical, shard_digests
from quillon.schemas import SOURCE
from quillon.sources.parquet import read_source, zip_rows
from quillon.sources.plugin import ParquetShards, back_end, register

from .test_functions import wav


class Counted(ParquetShards):
    """A back end of a test's own, named by module and class: it says which shards it was asked for."""

    def tables(self, shard, want):
        with open(self.options_log, "a") as f:
            f.write(f"{shard} {','.join(want.names)}\n")
        yield from super().tables(shard, want)

    def __init__(self, folder, options):
        super().__init__(folder, options)
        self.options_log = options["log"]


def write_shard(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}.dir")
    part = next(n for n in os.listdir(f"{path}.dir") if n.endswith(".parquet"))
    os.rename(f"{path}.dir/{part}", path)


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    """The same clips as Parquet shards and as folders of WAV files."""
    root = tmp_path_factory.mktemp("both")
    schema = "utterance_id string, airport string, tails array<string>, audio struct<bytes:binary,path:string>, start timestamp_ntz, duration_s double, extra int"
    from datetime import datetime

    for shard in (0, 3, 4, 12):
        rows = []
        folder = root / "wav" / f"shard-{shard:05d}"
        folder.mkdir(parents=True)
        with open(folder / "meta.jsonl", "w") as meta:
            for i in range(shard * 100 if shard == 3 else 2):
                clip = bytes(wav([0.01 * (i % 50)] * 20)) if i % 5 else None
                tails = None if i % 3 == 0 else ["N1", None, ""]
                rows.append((f"é{shard}/{i}", "kxyz", tails, None if clip is None else (clip, f"{i}.wav"), datetime(2024, 1, 2, 3, i % 60), 0.5 * i, 7))
                if clip is not None:
                    (folder / f"{i}.wav").write_bytes(clip)
                line = {"utterance_id": f"é{shard}/{i}", "airport": "kxyz", "tails": tails, "audio": None if clip is None else f"{i}.wav", "duration_s": 0.5 * i}
                meta.write(json.dumps(line | {"start": datetime(2024, 1, 2, 3, i % 60).isoformat()}) + "\n\n")
        write_shard(spark, rows, schema, str(root / f"shard-{shard:05d}.parquet"))
    register(spark)
    return root


def test_back_ends_give_equal_rows(spark, both):
    want = read_source(spark, str(both))
    key = lambda df: sorted((r.asDict(True) for r in df.collect()), key=lambda r: (r["shard"], r["pos"]))
    parquet = spark.read.format("quillon_shards").option("path", f"file:{both}").load()
    waves = spark.read.format("quillon_shards").option("path", f"{both}/wav").option("back_end", "wav").load()
    assert parquet.schema == waves.schema and parquet.columns == want.columns
    assert key(parquet) == key(waves) == key(want) and len(key(want)) == 306
    few = spark.read.format("quillon_shards").schema("pos long, utterance_id string").option("path", str(both)).load()
    assert few.filter("pos = 299").first()["utterance_id"] == "é3/299"


def test_only_asked_shards_are_planned_and_read(spark, both, tmp_path):
    log = str(tmp_path / "log")
    made = lambda spec: spark.read.format("quillon_shards").schema("utterance_id string, shard int").option("path", str(both)).option("back_end", "tests.test_shards:Counted").option("log", log).option("shards", spec)
    assert made("3-9,50").load().rdd.getNumPartitions() == 2 and made("").load().rdd.getNumPartitions() == 4
    assert made("3-9,50").load().count() == 302
    assert {line.split()[0] for line in open(log)} == {"3", "4"}
    os.remove(log)
    got = made("").load().filter("shard >= 4 and shard < 12 and utterance_id <> 'x'")
    assert got.rdd.getNumPartitions() == 1 and got.count() == 2 and {line.split()[0] for line in open(log)} == {"4"}
    assert made("").load().filter("shard in (0, 12)").count() == 4 and made("").load().filter("shard = 99").count() == 0


def test_odd_sources(spark, both, tmp_path):
    read = lambda **o: spark.read.format("quillon_shards").options(**o).load()
    assert read(path=str(tmp_path / "none")).count() == 0
    for options, message in (({}, "path"), ({"path": str(both), "back_end": "tape"}, "module:Class")):
        with pytest.raises(Exception, match=message):
            read(**options).count()
    bad = tmp_path / "shard-00001"
    bad.mkdir()
    (bad / "meta.jsonl").write_text('{"utterance_id": "a", "audio": "../secret.wav"}\n')
    with pytest.raises(Exception, match="file of its shard"):
        read(path=str(tmp_path), back_end="wav").collect()
    assert back_end("parquet") is ParquetShards


@pytest.mark.parametrize("strict", [False, True])
def test_rows_pair_as_zip_does(spark, tmp_path, strict):
    for shard, n, m in ((1, 1000, 1000), (2, 10, 10 if strict else 7), (5, 0, 0)):
        write_shard(spark, [(f"{shard}:{i}", "x" * (i % 90)) for i in range(n)], "utterance_id string, airport string", str(tmp_path / f"shard-{shard:05d}.parquet"))
        os.makedirs(tmp_path / "labels", exist_ok=True)
        write_shard(spark, [(f"label {shard}:{i}",) for i in range(m)], "transcript string", str(tmp_path / f"labels/shard-{shard:05d}.parquet"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # splits within files
    try:
        source = read_source(spark, str(tmp_path), schema="utterance_id string, airport string")
        labels = read_source(spark, f"{tmp_path}/labels", schema="transcript string")
        got = zip_rows(source, labels, strict)
        assert source.rdd.getNumPartitions() > 3 and "Sort " not in got._jdf.queryExecution().executedPlan().toString()
        rows = got.collect()
        assert len(rows) == (1010 if strict else 1007) and all(r["transcript"] == f"label {r['utterance_id']}" for r in rows)
        if strict:
            with pytest.raises(Exception, match="has no mate"):
                zip_rows(source, labels.filter("not (shard = 1 and pos = 5)"), True).collect()
        with pytest.raises(ValueError, match="transcript"):
            zip_rows(labels, labels)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_canonical_json_is_that_of_a_plain_serialiser(spark):
    rng = random.Random(3)
    doubles = [0.0, -0.0, 1e-7, 1.5e-7, 1e7, 1e15, 1e16, 1e17, 1e21, 1e22, 1e23, 5e-324, 1.7976931348623157e308, 0.1 + 0.2, 1 / 3, 123456789.123456789, float("inf"), float("-inf")]
    doubles += [rng.uniform(-1, 1) * 10 ** rng.randrange(-20, 23) for _ in range(400)]
    texts = ["", "é", "日本", "😀  ", 'quote " back \\ / slash', "\x00\x01\x1f\x7f", "\n\r\t\b\f", "�￿", None]
    rows = [(f, 2**62 - i, texts[i % len(texts)], i % 2 == 0, [None, f], {"é": 1, "a": None}, (None, texts[-2 - i % 3])) for i, f in enumerate(doubles)]
    rows.append((None,) * 7)
    schema = "zz double, b long, text string, ok boolean, list array<double>, map map<string,int>, nested struct<z:string,a:string>"
    got = spark.createDataFrame(rows, schema).repartition(3).select("zz", canonical(["zz", "b", "text", "ok", "list", "map", "nested"]).alias("j"), "b", "text", "ok", "list", "map", "nested")
    for r in got.collect():
        plain = {k: (v.asDict() if hasattr(v, "asDict") else v) for k, v in r.asDict().items() if k != "j"}
        assert r["j"] == json.dumps(plain, sort_keys=True, separators=(",", ":"))
    with pytest.raises(Exception, match="not JSON serializable"):
        spark.sql("select date'2024-01-01' as d").select(canonical(["d"])).collect()


def test_streamed_digests_equal_whole_ones(spark):
    rng = random.Random(7)
    rows = [(rng.choice([None, 0, 1, 2]), rng.choice([None, f"u{rng.randrange(400)}"]), rng.choice([None, "é" * rng.randrange(9), f"line {i}"])) for i in range(3000)]
    rows += [(9, "only", None), (8, "a", ""), (8, "b", "")]
    df = spark.createDataFrame(rows, "shard int, utterance_id string, line string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")  # a shard is many batches
    try:
        got = {r["shard"]: r["digest"] for r in shard_digests(df.repartition(6), F.col("line")).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    low = lambda x: (x is not None, x or "")
    for shard in {s for s, _, _ in rows}:
        lines = [line for _, _, line in sorted((r for r in rows if r[0] == shard), key=lambda r: (low(r[1]), low(r[2])))]
        assert got.pop(shard) == hashlib.sha256("\n".join(line for line in lines if line is not None).encode()).hexdigest()
    assert not got
