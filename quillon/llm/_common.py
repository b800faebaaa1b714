"""Helpers shared by the training-data operators: reading, saving and hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the white space of the word contracts, as a Java or RE2 character class.
SPACE = r"\x20\x09-\x0D"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it in spark.checkpoint.dir or by setCheckpointDir()."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at is None:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not found.isDefined():
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = found.get()
    return at


def saved(df: DataFrame, compression: str = "snappy", **options: str) -> DataFrame:
    """The rows of df, written once to the shared folder and read back: later steps start from the files, so a lost executor costs no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/quillon-{uuid.uuid4().hex}"
    df.write.option("compression", compression).options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def put_file(spark: SparkSession, parts: Iterable[bytes], step: int = 1 << 22) -> str:
    """Writes the parts as one file of the shared folder and gives each executor a copy of its own; returns the name for SparkFiles.get().

    Processes of an executor that map the file into memory share its pages. The file stays for the session.
    """
    sc, name = spark.sparkContext, f"quillon-{uuid.uuid4().hex}"
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    for part in parts:
        for at in range(0, len(part), step):
            out.write(bytearray(part[at : at + step]))
    out.close()
    sc.addFile(path.toString())
    return name


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else. lower() does the same, and faster, where all is ASCII."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))
