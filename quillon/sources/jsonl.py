"""JSON lines: strict reads with a schema, and reads that forgive a torn last line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import shard_index
from .shards import file_names


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Rows of the schema; blank lines are skipped, a line that is no JSON of it stops the query. Unknown fields are dropped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_shards(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All shard-NNNNN.jsonl of a folder with their shard number; empty where there are none."""
    paths = file_names(spark, folder, "shard-*.jsonl*")
    if not paths:
        return spark.createDataFrame([], f"{schema}, shard int")
    return read_jsonl(spark, paths, schema).withColumn("shard", shard_index(F.col("_metadata.file_name")))


def read_jsonl_recoverable(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows with file and pos (place in the file). A last line that is torn is dropped; an earlier one stops the query.

    Only append-only logs, of a file a shard and small, are read so: a file is one row while it is split.
    No file gives no rows.
    """
    paths = file_names(spark, path.rpartition("/")[0], path.rpartition("/")[2])
    if not paths:
        return spark.createDataFrame([], f"{schema}, file string, pos int")
    whole = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.regexp_replace("value", "\n$", "").alias("_all"))
    lines = whole.select("file", F.size(F.split("_all", "\n")).alias("_n"), F.posexplode(F.split("_all", "\n")).alias("pos", "_line"))
    kept = lines.filter(F.trim("_line") != "")
    read = kept.withColumn("_row", F.from_json("_line", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    torn = F.col("_row._bad").isNotNull() | F.col("_row").isNull()
    error = F.raise_error(F.concat(F.lit("line "), F.col("pos"), F.lit(" is no JSON: "), F.col("file"))).cast("boolean")
    good = read.filter(F.when(~torn, True).when(F.col("pos") == F.col("_n") - 1, False).otherwise(error))
    names = [f.name for f in spark.createDataFrame([], schema).schema]
    return good.select(*[F.col(f"_row.{n}").alias(n) for n in names], "file", "pos")
