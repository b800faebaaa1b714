"""Writers: partitioned stages that resume, one ordered Parquet file a shard, the card, JSON lines, appended events."""

from __future__ import annotations

import json
import time
import uuid
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.review import published, training_rows
from ..operators.snapshot import json_line, snapshot
from ..operators.tables import pending


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, name: str) -> bool:
    path, fs = _path(spark, name)
    return fs.exists(path)


def delete(spark: SparkSession, name: str) -> None:
    """Removes a file or folder, if it is there."""
    path, fs = _path(spark, name)
    fs.delete(path, True)


def _is_local(fs) -> bool:
    return fs.getUri().getScheme() == "file"


def _local(spark: SparkSession, fs, path):
    return spark._jvm.java.nio.file.Paths.get(fs.makeQualified(path).toUri().getPath(), spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0))


def _write_new(spark: SparkSession, beside: str, data: bytes):
    """(path, file system) of a whole new file beside the name, hidden from readers."""
    folder, _, last = beside.rpartition("/")
    new, fs = _path(spark, f"{folder}/.{last}.{uuid.uuid4().hex}.new")
    fs = fs.getRawFileSystem() if _is_local(fs) else fs  # without a checksum beside it, which a rename of the file alone would leave
    out = fs.create(new, True)
    out.write(bytearray(data))
    out.close()
    return new, fs


def replace(spark: SparkSession, new, name: str) -> None:
    """Renames new to name in one step, over what is there: a reader finds the old file or the new one, never none."""
    path, fs = _path(spark, name)
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    if _is_local(fs):  # its own rename deletes first
        fs.getRawFileSystem().delete(fs.getChecksumFile(path), False)
        options = gateway.new_array(jvm.java.nio.file.CopyOption, 1)
        options[0] = jvm.java.nio.file.StandardCopyOption.ATOMIC_MOVE
        jvm.java.nio.file.Files.move(_local(spark, fs, new), _local(spark, fs, path), options)
        return
    how = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(new, path, how)


def write_text(spark: SparkSession, name: str, text: str) -> None:
    """A small file as a whole: under another name first, then renamed over what is there."""
    new, _ = _write_new(spark, name, text.encode())
    replace(spark, new, name)


def read_text(spark: SparkSession, name: str) -> str:
    """A small file as a whole."""
    path, fs = _path(spark, name)
    opened = fs.open(path)
    try:
        return bytes(opened.readAllBytes()).decode()
    finally:
        opened.close()


def create_only(spark: SparkSession, name: str, data: bytes) -> bool:
    """Creates the file with its whole content, or gives False where the name is taken: of several writers one gets True."""
    new, fs = _write_new(spark, name, data)
    path, _ = _path(spark, name)
    try:
        if _is_local(fs):
            spark._jvm.java.nio.file.Files.createLink(_local(spark, fs, path), _local(spark, fs, new))
        else:
            none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
            spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(new, path, none)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(new, False)
    return True


def done_shards(spark: SparkSession, folder: str, by: tuple[str, ...] = ("shard",)) -> DataFrame:
    """(*by) with an output partition in the folder: shard is an int, what else is in by (the model) a string."""
    path, fs = _path(spark, "/".join([folder, *(f"{c}=*" for c in by)]))
    schema = ", ".join(f"{c} {'int' if c == 'shard' else 'string'}" for c in by)
    found = []
    for status in fs.globStatus(path) or []:
        parts = [unquote(part.partition("=")[2]) for part in status.getPath().toString().split("/")[-len(by) :]]
        found.append(tuple(int(v) if c == "shard" else v for c, v in zip(by, parts, strict=True)))
    return spark.createDataFrame(found, schema)


def write_stage(rows: DataFrame, folder: str, by: tuple[str, ...] = ("shard",), seen: Observation | None = None, metrics: dict[str, Column] | None = None) -> None:
    """rows as Parquet by shard, or by what by names, in order of pos; partitions that rows have are replaced, others stay.

    With by=("model", "shard") a model's shard leaves those of other models as they are. metrics are aggregates that seen gets on the way: of the rows
    as they are written, after the last shuffle, so that a task tried again counts once.
    """
    ordered = rows.repartition(*by).sortWithinPartitions(*by, "pos")
    if seen is not None:
        ordered = ordered.observe(seen, *[c.alias(name) for name, c in (metrics or {}).items()])
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(folder)


def write_pending(rows: DataFrame, folder: str, by: tuple[str, ...] = ("shard",)) -> None:
    """Only the shards, or (model, shard), that have no output yet."""
    spark = rows.sparkSession
    left = pending(rows, done_shards(spark, folder, by), *by)
    write_stage(rows.join(F.broadcast(left), list(by), "left_semi"), folder, by)  # a few numbers for each file


def publish_shards(rows: DataFrame, folder: str, card: str | None = None, form: str = "parquet") -> tuple[int, int]:
    """One shard-NNNNN file for each shard, its rows in order of pos, and the card; (shards, rows).

    rows have shard and pos besides what is published. Each shard is sorted and written by one task as one file, which the
    driver then renames over what is there. form is parquet, or jsonl: lines as a plain serialiser writes them, columns in their order. Rows are counted as they are written.
    """
    if form not in ("parquet", "jsonl"):
        raise ValueError("form is 'parquet' or 'jsonl'")
    spark, seen = rows.sparkSession, Observation()
    temp = f"{folder}/_new-{uuid.uuid4().hex}"
    named = rows.withColumn("_shard", F.col("shard"))
    if form == "jsonl":
        named = named.select("_shard", "pos", "shard", json_line([c for c in rows.columns if c not in ("shard", "pos")]).alias("value"))
    ordered = named.repartition("_shard").sortWithinPartitions("_shard", "pos").drop("pos", "shard").observe(seen, F.count(F.lit(1)).alias("n"))
    written = ordered.write.option("maxRecordsPerFile", 0).partitionBy("_shard")
    written.parquet(temp) if form == "parquet" else written.text(temp)
    base, fs = _path(spark, temp)
    shards = 0
    for status in fs.globStatus(_path(spark, f"{temp}/_shard=*/part-*")[0]) or []:
        index = int(status.getPath().getParent().getName().partition("=")[2])
        replace(spark, status.getPath(), f"{folder}/shard-{index:05d}.{form}")
        shards += 1
    fs.delete(base, True)
    count = seen.get["n"]
    if card is not None:
        write_text(spark, f"{folder}/README.md", fill_card(card, count, shards))
    return shards, count


def write_dataset(rows: DataFrame, folder: str) -> tuple[int, int]:
    """Effective labels (with shard and pos) as they are published, as JSON lines: (shards, rows)."""
    return publish_shards(published(rows, "shard", "pos"), folder, form="jsonl")


def write_trainset(rows: DataFrame, folder: str, tiers: tuple[str, ...] = ("gold", "silver")) -> tuple[int, int]:
    """The training rows of effective labels (with shard and pos) as JSON lines: (shards, rows)."""
    return publish_shards(training_rows(rows, tiers, "shard", "pos"), folder, form="jsonl")


def write_snapshot(rows: DataFrame, events: DataFrame, folder: str, name: str, ts: float | None = None, tiers: list[str] | None = None) -> str:
    """The snapshot of effective labels as <folder>/<name>.json, one line, in place of an earlier one; its path. A number for each shard is all the driver gets."""
    if not name or "/" in name:
        raise ValueError("a snapshot's name is the name of a file")
    one = snapshot(rows, events, name, time.time() if ts is None else ts, tiers).first().asDict()
    write_text(rows.sparkSession, f"{folder}/{name}.json", json.dumps(one) + "\n")
    return f"{folder}/{name}.json"


def fill_card(card: str, rows: int, shards: int) -> str:
    """The card with __N_ROWS__ (thousands apart) and __N_SHARDS__ filled in."""
    return card.replace("__N_ROWS__", f"{rows:,}").replace("__N_SHARDS__", str(shards))


def write_jsonl(rows: DataFrame, folder: str) -> int:
    """JSON lines in a folder; the number of rows, counted on the way. All or nothing, by Spark's commit."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("ignoreNullFields", "false").json(folder)
    return seen.get["n"]


def append_rows(rows: DataFrame, folder: str) -> None:
    """Adds files with the rows; what is there stays."""
    rows.write.mode("append").option("ignoreNullFields", "false").json(folder)
