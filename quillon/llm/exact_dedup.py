"""Exact dedup: 128-bit content hash groups, bytes compared inside them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import saved, text_or_empty

#: A text that more than this share of the rows have is met by a broadcast: 1 / HOT_SHARE texts at most.
HOT_SHARE = 1e-3


def md5_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    content_hash: Callable[[Column], Column] = md5_hash,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by (128-bit hash, text): hash first, and the aggregate's own key comparison
    looks at the bytes of texts that share a hash, so a hash collision never joins two texts. Equal
    rows fold into one before the shuffle, which is what makes a text that a third of all rows
    share cheap. Rows find their class again by (hash, SHA-256); two classes with the same pair
    stop the query instead of mixing. That join shuffles no texts. The classes of over HOT_SHARE of all
    rows, 1 / HOT_SHARE of them at most, are broadcast, so that their rows stay where they are.

    keep is "min" (smallest id stays) or "max". A null text is the empty text. A null id never
    wins over another id; a group that has no other id has a null keep_id and keeps its rows. Rows
    that repeat both id and text are counted in group_size and get the same verdict. Other columns
    of the input are not read. An empty table gives an empty result.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text")).withColumn(
        "_hash", content_hash(F.col("_text"))
    )
    pick = F.min if keep == "min" else F.max
    classes = rows.groupBy("_hash", "_text").agg(pick("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    found = saved(
        classes.select("_hash", F.unhex(F.sha2("_text", 256)).alias("_sha"), "_keep", "_n")
        .groupBy("_hash", "_sha")
        .agg(F.first("_keep").alias("_keep"), F.first("_n").alias("_n"), F.count(F.lit(1)).alias("_classes"))
        .select(
            "_hash",
            "_sha",
            "_keep",
            F.when(F.col("_classes") == 1, F.col("_n"))
            .otherwise(F.raise_error(F.lit("two different texts share both hashes")).cast("long"))
            .alias("_n"),
        )
    )
    total = found.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hot = found.filter(F.col("_n") > HOT_SHARE * total)
    short = saved(rows.select("_id", "_hash", F.unhex(F.sha2("_text", 256)).alias("_sha")))
    key = ["_hash", "_sha"]
    told = short.join(F.broadcast(hot), key).unionByName(
        short.join(F.broadcast(hot.select(*key)), key, "left_anti").join(found.filter(F.col("_n") <= HOT_SHARE * total), key)
    )
    return told.select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep="max")


OP9_SQL = """
select doc_id,
       max(doc_id) over (partition by coalesce(text, '')) as keep_id,
       count(*) over (partition by coalesce(text, '')) as group_size,
       doc_id = max(doc_id) over (partition by coalesce(text, '')) as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents
"""
