"""Shards of a run: names, listings, specifications."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import shard_index


def parse_shard_spec(spec: str) -> list[int]:
    """"0-46,150" to sorted distinct numbers; ranges have both ends. Blank parts are left out."""
    out: set[int] = set()
    for part in spec.split(","):
        low, dash, high = part.strip().partition("-")
        if low:
            out.update(range(int(low), int(high if dash else low) + 1))
    return sorted(out)


def expand_spec(spec: DataFrame, low: str, high: str) -> DataFrame:
    """The distinct numbers of inclusive ranges, one a row."""
    return spec.filter(F.col(low) <= F.col(high)).select(F.explode(F.sequence(low, high)).alias("shard")).distinct()


def file_names(spark: SparkSession, folder: str, pattern: str = "shard-*") -> list[str]:
    """Paths in a folder of any file system that Spark reads; none where it does not exist."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{pattern}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(s.getPath().toString() for s in found or [])


def list_shards(spark: SparkSession, folder: str, pattern: str = "shard-*") -> DataFrame:
    """(shard) by number, from the names of the files."""
    names = spark.createDataFrame([(n,) for n in file_names(spark, folder, pattern)], "name string")
    return names.select(shard_index(F.col("name")).alias("shard")).filter("shard is not null").distinct().orderBy("shard")


def comma_list(value: str | None) -> list[str]:
    """Trimmed parts of a comma list, blanks dropped."""
    return [p.strip() for p in (value or "").split(",") if p.strip()]


def shard_number(name: str) -> int | None:
    """The number in the name of a shard's file or folder."""
    found = re.search(r"shard-(\d+)", name)
    return int(found[1]) if found else None


def file_system(name: str):
    """(pyarrow file system, path in it) of a path or URI, as Spark names them: what tasks read and write by themselves."""
    from pyarrow import fs

    if "://" not in name and not name.startswith("file:"):
        return fs.LocalFileSystem(), name
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", name))
