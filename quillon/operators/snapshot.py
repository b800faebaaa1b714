"""Content-addressed snapshots: counts, a digest a shard, a digest of digests."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import shard_stem


def tier_counts(rows: DataFrame) -> DataFrame:
    """(tier, n) and a row with tier null for all."""
    return rows.rollup("tier").agg(F.count(F.lit(1)).alias("n"))


def _dumper(**form):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            yield pa.array([json.dumps(r, **form) for r in rows.to_pylist(maps_as_pydicts="strict")], pa.string())

    return run


def json_line(columns: list[str]) -> Column:
    """JSON of the columns in the order given, as a plain serialiser writes a row by default: values as in canonical(), a space after comma and colon."""
    return F.arrow_udf(_dumper(), "string")(F.struct(*columns))


def canonical(columns: list[str]) -> Column:
    """JSON of the columns, byte for byte as a plain serialiser gives it: the form that digests are taken of.

    Keys are sorted at each depth and nothing is spaced; nulls are kept; what is not ASCII is escaped, beyond the basic plane as a pair; doubles have their
    shortest form that reads back the same (1e-07, 1e+22, 10000000.0), and NaN, Infinity and -Infinity. Columns may be text, booleans, whole numbers, doubles,
    and arrays, structs and maps with text as keys of these; of other types (dates, decimals, bytes) there is no such form, and they stop the query.
    """
    return F.arrow_udf(_dumper(sort_keys=True, separators=(",", ":")), "string")(F.struct(*sorted(columns)))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, digest) of lines in order of shard: only the hash that runs is held."""
    none = object()
    shard, running, empty = none, None, True

    def told():
        return pa.RecordBatch.from_arrays([pa.array([shard], kind), pa.array([running.hexdigest()])], names=["shard", "digest"])

    for batch in batches:
        kind, lines = batch.column(0).type, batch.column(1).to_pylist()
        runs = pc.run_end_encode(batch.column(0))
        for first, end, value in zip([0, *runs.run_ends.to_pylist()], runs.run_ends.to_pylist(), runs.values.to_pylist(), strict=False):
            if value != shard or running is None:
                if running is not None:
                    yield told()
                shard, running, empty = value, hashlib.sha256(), True
            some = [line for line in lines[first:end] if line is not None]
            if some:
                running.update((("" if empty else "\n") + "\n".join(some)).encode())
                empty = False
    if running is not None:
        yield told()


def shard_digests(rows: DataFrame, line: Column, key: str = "utterance_id") -> DataFrame:
    """(shard, digest): SHA-256 over a shard's lines by key, then line, with a line feed between them. line is a Column of text; null lines are left out.

    A shard's lines are sorted by Spark, which spills, and fed to its hash as they come: a task holds a batch of lines, whatever the shard's size.
    """
    kind = rows.schema["shard"].dataType.simpleString()
    keyed = rows.select("shard", F.col(key).alias("_key"), line.alias("_line"))
    ordered = keyed.repartition("shard").sortWithinPartitions("shard", "_key", "_line").select("shard", "_line")
    return ordered.mapInArrow(_hashed, f"shard {kind}, digest string")


def snapshot_digest(digests: DataFrame) -> DataFrame:
    """One row: SHA-256 over "shard-NNNNN:digest" lines in order of the shards' names."""
    lines = F.array_sort(F.collect_list(F.concat_ws(":", shard_stem(F.col("shard")), "digest")))
    return digests.agg(F.sha2(F.array_join(lines, "\n"), 256).alias("digest"))


def snapshot(rows: DataFrame, events: DataFrame, name: str, ts: float, tiers: list[str] | None = None) -> DataFrame:
    """One row: name, ts, review_offset, digest, shards, total, by_tier, tiers. rows are effective labels with their shard."""
    per_shard = shard_digests(rows, canonical([c for c in rows.columns if c not in ("shard", "pos")]))
    shards = per_shard.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(shard_stem(F.col("shard")), "digest")))).alias("shards"),
    )
    counts = rows.groupBy("tier").agg(F.count(F.lit(1)).alias("n"))
    by_tier = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.map_from_entries(F.collect_list(F.struct("tier", "n"))).alias("by_tier"))
    offset = events.agg(F.coalesce(F.max("seq") + 1, F.lit(0)).cast("long").alias("review_offset"))
    one = shards.crossJoin(snapshot_digest(per_shard)).crossJoin(by_tier).crossJoin(offset)  # single rows
    wanted = F.lit(None).cast("array<string>") if tiers is None else F.array(*[F.lit(t) for t in tiers]).cast("array<string>")
    return one.select(F.lit(name).alias("name"), F.lit(float(ts)).alias("ts"), "review_offset", "digest", "shards", "total", "by_tier", wanted.alias("tiers"))
