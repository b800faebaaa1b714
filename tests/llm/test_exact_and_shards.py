import math
import struct
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from quillon.llm import exact_dedup as exact_module
from quillon.llm.exact_dedup import OP9_SQL, exact_dedup, op9_exact_dedup
from quillon.llm.sharding import op8_sharding, shard_records

from ..compare import duckdb_rows, rows_of

ODD = "doc_id long, text string, _id string, _hash string, _text int, kept int, shard string, size string, slot string"


def odd(spark, rows):
    """Tables whose other columns have the names that operators use inside."""
    return spark.createDataFrame([(i, t, "x", "y", 1, 2, "z", "s", "t") for i, t in rows], ODD)


ROWS = [(1, "a"), (2, None), (3, ""), (4, "a"), (4, "a"), (None, "b"), (None, None), (7, "A"), (8, "é" * 50_000), (9, "é" * 50_000), (10, "solo")]


def test_exact_dedup_equals_sql(spark, sf_dir):
    assert rows_of(op9_exact_dedup(spark, sf_dir)) == duckdb_rows(OP9_SQL, sf_dir)


@pytest.mark.parametrize("hot_share", [0.2, 1e-3, 1.0])
@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_dedup_odd_rows(spark, monkeypatch, keep, hot_share):
    monkeypatch.setattr(exact_module, "HOT_SHARE", hot_share)  # some classes are broadcast, all, none
    got = exact_dedup(odd(spark, ROWS), keep=keep).collect()
    assert len(got) == len(ROWS)
    groups = {}
    for i, t in ROWS:
        groups.setdefault(t or "", []).append(i)
    pick = min if keep == "min" else max
    want = Counter((i, pick([x for x in groups[t or ""] if x is not None], default=None), len(groups[t or ""])) for i, t in ROWS)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == want
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got)


def test_exact_dedup_survives_hash_collisions(spark):
    weak = lambda text: F.unhex(F.md5(F.substring(text, 1, 1)))
    docs = spark.createDataFrame([(i, f"x{i % 3}") for i in range(30)], "doc_id long, text string")
    got = exact_dedup(docs, content_hash=weak).collect()
    assert {(r["doc_id"] % 3, r["keep_id"], r["group_size"]) for r in got} == {(k, k, 10) for k in range(3)}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert exact_dedup(empty).count() == 0 and shard_records(empty).count() == 0


def test_shards(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op8_sharding(spark, sf_dir).collect()
    assert len(got) == len(docs) and {r["law"] for r in got} == {"key"}
    for r in got:
        data = (docs[r["doc_id"]] or "").encode()
        assert r["size"] == len(data) + 8 and r["text_crc32"] == zlib.crc32(data)
        assert r["grown_shard"] in (r["shard"], 24) and 0 <= r["shard"] < 24
    for s in range(24):
        own = sorted(r["slot"] for r in got if r["shard"] == s)
        assert own == list(range(len(own)))


def plain_shard(key, weights):
    own = xxhash.xxh64_intdigest(struct.pack("<Q", xxhash.xxh64_intdigest(str(key), 42)), 42)
    unit = [((xxhash.xxh64_intdigest(struct.pack("<i", s), own) >> 11) + 0.5) * 2.0**-53 for s in range(len(weights))]
    return min(range(len(weights)), key=lambda s: -math.log(unit[s]) / weights[s])


def test_shards_against_plain_rendezvous(spark):
    weights = [1.0, 2.5, 1.0, 0.5, 3.0]
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    for r in shard_records(docs, 5, weights, grown_weight=2.0).collect():
        assert r["shard"] == plain_shard(r["doc_id"], weights) and r["grown_shard"] == plain_shard(r["doc_id"], [*weights, 2.0])


def test_one_id_with_many_texts_is_many_slices(spark, monkeypatch):
    from quillon.llm import sharding

    monkeypatch.setattr(sharding, "SLICE_ROWS", 16)
    docs = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    got = shard_records(docs.union(docs.limit(5)), 3).collect()
    assert len({r["shard"] for r in got}) == 1 and sorted(r["slot"] for r in got) == list(range(2005))


def test_weights_growth_and_odd_rows(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    share = Counter(r["shard"] for r in shard_records(docs, 3, [1.0, 2.0, 5.0]).collect())
    assert [share[s] / 20_000 for s in range(3)] == pytest.approx([1 / 8, 2 / 8, 5 / 8], abs=0.015)
    moved = shard_records(docs, 4).filter("grown_shard <> shard")
    assert moved.filter("grown_shard <> 4").count() == 0 and moved.count() / 20_000 == pytest.approx(1 / 5, abs=0.015)
    got = shard_records(odd(spark, ROWS), 2, carry=["_hash", "kept"]).collect()
    assert len(got) == len(ROWS) and all(r["_hash"] == "y" and r["kept"] == 2 for r in got)
    for s in (0, 1):
        own = sorted(r["slot"] for r in got if r["shard"] == s)
        assert own == list(range(len(own)))
    assert len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    with pytest.raises(ValueError):
        shard_records(docs, 2, [1.0])
