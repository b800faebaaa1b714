"""Sharding by weighted rendezvous hashing of stable record keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import table


def rendezvous_shard(key: Column, weights: list[float]) -> Column:
    """The shard whose draw -ln(u)/weight is smallest; u in (0, 1) comes from a hash of key and shard.

    Shard s draws alike whatever the number of shards, so one more shard only takes rows, and
    takes its weight's share of them. Equal draws go to the smaller shard number.
    """
    unit = lambda s: (F.shiftrightunsigned(F.xxhash64(key, F.lit(s)), 11).cast("double") + 0.5) * F.lit(2.0**-53)
    draws = [F.struct((-F.log(unit(s)) / F.lit(float(w))).alias("d"), F.lit(s).alias("s")) for s, w in enumerate(weights)]
    return F.array_min(F.array(*draws)).getField("s")


#: Rows that are numbered together, where MAX_SLICES allows it; the table of offsets has MAX_SLICES rows at most.
SLICE_ROWS, MAX_SLICES = 4096, 1_000_000


def add_slots(rows: DataFrame, keys: DataFrame, order: list[str]) -> DataFrame:
    """Numbers the rows of each shard from 0 without a gap, in parallel.

    rows and keys hold _shard and _slice (a hash of the row). Each (shard, slice) is numbered on
    its own and moved by the number of rows in the shard's earlier slices. That table of offsets
    has MAX_SLICES rows at most, whatever the input, and is broadcast.
    """
    upto = Window.partitionBy("_shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keys.groupBy("_shard", "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_shard", "_slice", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_offset"))
    )
    own = Window.partitionBy("_shard", "_slice").orderBy(*order)
    return (
        rows.withColumn("_nth", F.row_number().over(own))
        .join(F.broadcast(offsets), ["_shard", "_slice"])
        .withColumn("_slot", F.col("_offset") + F.col("_nth") - 1)
    )


def shard_records(
    docs: DataFrame,
    n_shards: int = 24,
    weights: list[float] | None = None,
    grown_weight: float = 1.0,
    slices: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard, and the columns named in carry.

    size is the UTF-8 bytes of the text plus 8. grown_shard is the shard with one more shard of
    weight grown_weight. slot numbers the rows of a shard from 0 by (slice, id, text checksum); a slice is
    a hash of id, checksum and size, so that one id with many texts is many slices. There are as many slices as give some
    SLICE_ROWS rows each (MAX_SLICES over all shards at most), or as slices says.
    Only the key decides the shard: rows with the same id, null ids among them, share a shard, and
    rows that repeat a whole record get the numbers next to each other. A null text has no bytes
    and the checksum 0. carry names input columns to keep; other columns of the input are not
    read, and none can clash with the names used here. An empty table gives an empty result.
    """
    weights = [1.0] * n_shards if weights is None else [float(w) for w in weights]
    if len(weights) != n_shards or min(weights) <= 0:
        raise ValueError("one positive weight per shard is needed")
    if slices is None:
        slices = max(1, min(-(-docs.count() // (n_shards * SLICE_ROWS)), MAX_SLICES // n_shards))
    if n_shards * slices > MAX_SLICES:
        raise ValueError(f"n_shards * slices is limited to {MAX_SLICES}, as the offsets are broadcast")
    told = [
        F.xxhash64(F.col(id_col).cast("string")).alias("_key"),
        F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("_bytes"),
        F.coalesce(F.crc32(F.col(text_col).cast("string").cast("binary")), F.lit(0)).cast("long").alias("_crc"),
    ]
    placed = [
        rendezvous_shard(F.col("_key"), weights).alias("_shard"),
        F.pmod(F.xxhash64("_key", "_crc", "_bytes"), F.lit(slices)).cast("int").alias("_slice"),
    ]
    keys = docs.select(*told).select(*placed)
    rows = docs.select(
        *told,
        F.col(id_col).alias("_id"),
        F.struct(*[F.col(c) for c in carry or [id_col]]).alias("_carried"),
    ).select("*", *placed, rendezvous_shard(F.col("_key"), [*weights, float(grown_weight)]).alias("_grown"))
    numbered = add_slots(rows, keys, ["_id", "_crc", "_bytes"])
    return numbered.select(
        F.col("_id").alias(id_col),
        (F.col("_bytes") + 8).alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("key").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").cast("long").alias("slot"),
        F.col("_grown").alias("grown_shard"),
        *[F.col("_carried").getField(c).alias(c) for c in carry or []],
    )


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    return shard_records(table(spark, sf_dir, "documents"))
