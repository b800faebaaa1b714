"""Source shards in Parquet: pruned scans, absent columns as nulls, clips with decoded audio."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.audio import MIN_SAMPLES, decode_audio
from ..functions.text import present_tails, shard_index
from ..schemas import SOURCE
from .shards import file_names


def read_source(spark: SparkSession, folder: str, shards: list[int] | None = None, schema: str = SOURCE) -> DataFrame:
    """The columns of the schema, null where a file lacks one, with shard and pos (place in the file). shards picks files."""
    want = StructType.fromDDL(schema)
    paths = file_names(spark, folder, "shard-*.parquet")
    if shards is not None:
        names = {f"shard-{i:05d}.parquet" for i in shards}
        paths = [p for p in paths if p.rpartition("/")[2] in names]
    if not paths:
        return spark.createDataFrame([], StructType.fromDDL(f"{schema}, shard int, pos long"))
    rows = spark.read.option("mergeSchema", "true").parquet(*paths)
    cols = [(F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in want]
    return rows.select(*cols, shard_index(F.col("_metadata.file_name")).alias("shard"), F.col("_metadata.row_index").alias("pos"))


def meta_rows(source: DataFrame) -> DataFrame:
    """utterance_id, airport, tails (neither null nor empty) and where the row stands."""
    return source.select(F.col("utterance_id").cast("string"), F.col("airport").cast("string"), present_tails(F.col("tails")).alias("tails"), "shard", "pos")


def clips(source: DataFrame, rate: int | None = 16_000) -> DataFrame:
    """meta_rows with audio: struct<samples, rate>, mono, resampled, padded to the least a recogniser takes."""
    return source.select(
        F.col("utterance_id").cast("string"), "airport", present_tails(F.col("tails")).alias("tails"), "shard", "pos", "duration_s",
        decode_audio(F.col("audio.bytes"), rate, MIN_SAMPLES).alias("audio"),
    )


def zip_rows(left: DataFrame, right: DataFrame, strict: bool = False) -> DataFrame:
    """Rows of two sets of shards by their places: the nth row of a shard with the nth of the shard of that number, as zip() pairs them.

    Both have shard and pos, as read_source() gives them (the file's number and the row's index in it); other columns must not share names. What is
    paired is found by these two numbers alone, so files may be read in any number of splits, on either side, and nothing is sorted or gathered: one
    hash join, right being the side that is hashed. Rows beyond the end of the other side's shard are left out; strict stops the query at one.
    """
    both = set(left.columns) & set(right.columns) - {"shard", "pos"}
    if both:
        raise ValueError(f"columns of both sides: {', '.join(sorted(both))}")
    marked = right.withColumn("_right", F.lit(True)).hint("shuffle_hash")
    if not strict:
        return left.join(marked, ["shard", "pos"]).drop("_right")
    paired = left.withColumn("_left", F.lit(True)).join(marked, ["shard", "pos"], "full")
    error = F.raise_error(F.format_string("row %d of shard %d has no mate", "pos", "shard")).cast("boolean")
    return paired.filter(F.when(F.col("_left") & F.col("_right"), True).otherwise(error)).drop("_left", "_right")
