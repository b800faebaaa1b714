"""Session settings and tables written to the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(name: str = "quillon", **settings: str) -> SparkSession:
    """A session with the settings that the results rely on (UTC above all); given settings come on top."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which the driver and all executors must share."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at is None:
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return at


def saved(df: DataFrame) -> DataFrame:
    """The rows of df, written once to the shared folder and read back."""
    path = f"{shared_dir(df.sparkSession)}/quillon-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, *order, name: str = "position") -> DataFrame:
    """df with the place of each row, from 1, in a total order, without gathering the rows in one task.

    A range-partitioned sort numbers each partition on its own; the partitions' sizes, one row each, give the offsets.
    """
    part, nth = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = saved(df.sort(*order).withColumn("_at", F.monotonically_increasing_id()))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return placed.join(F.broadcast(offsets), part == F.col("_part")).withColumn(name, F.col("_offset") + nth + 1).drop("_part", "_offset", "_at")
