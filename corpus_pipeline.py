"""A training-data pipeline over documents: toxicity, near duplicates, leaks, mixture, shards.

An id may repeat or be null: stages tell documents apart by what they hold. Documents that agree in id, source and text meet the same fate, but for
near duplicates, of which one row stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm._common import saved, table
from quillon.llm.decontaminate import find_leaks
from quillon.llm.mixing import mix_sources
from quillon.llm.sharding import shard_records
from quillon.llm.simhash import near_duplicates
from quillon.llm.toxicity import THRESHOLD, op3_model, score_toxicity


def _packed(docs: DataFrame) -> DataFrame:
    """The whole document in one column, so that no column of it can clash with those of a stage, and what tells documents apart.

    An id may repeat. _content is 128 bits over id, source and text: documents that agree in all three are alike to every stage.
    """
    source = F.col("source") if "source" in docs.columns else F.lit(None).cast("string")
    told = [F.col("doc_id").cast("string"), source.cast("string"), F.col("text").cast("string")]
    told += [c.isNull() for c in told]
    content = F.struct(F.xxhash64(F.lit(1), *told).alias("a"), F.xxhash64(F.lit(2), *reversed(told)).alias("b"))
    return docs.select(F.struct("*").alias("_doc"), F.col("doc_id").alias("_id"), source.alias("_source"), F.col("text").alias("_text"), content.alias("_content"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the model calls toxic; it learns from the labels of these documents."""
    scored = score_toxicity(_packed(docs), op3_model(spark, sf_dir, docs), text_col="_text", name="_toxicity")
    return scored.filter(F.col("_toxicity.score") < THRESHOLD).select("_doc.*")


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: five-word shingles, a Jaccard similarity of 0.8 or more.

    SimHash links within 3 bits (op4's operator: pigeonring candidates, Hamming check, components) are met first; pairs that they leave apart come from bands. Each link is checked on the sets.
    The smallest id stays, a null id only where the group has no other; of rows with that id, the first as saved here.
    """
    nth = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.monotonically_increasing_id().alias("row"))
    numbered = saved(_packed(docs).select("_doc", nth.alias("_nth")))
    groups = near_duplicates(numbered.select("_nth", F.col("_doc.text").alias("_text")), width=5, least=0.8, id_col="_nth", text_col="_text")
    first = groups.filter("_nth = component_id").select(F.col("_nth.row").alias("_row"))
    return numbered.join(first, F.col("_nth.row") == F.col("_row"), "left_semi").select("_doc.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of a benchmark item occurs."""
    leaks = find_leaks(_packed(docs), table(spark, sf_dir, "benchmark"), id_col="_content", text_col="_text")
    bad = leaks.filter("contaminated").select(F.col("_content").alias("_bad"))
    return _packed(docs).join(bad, F.col("_content") == F.col("_bad"), "left_anti").select("_doc.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it, or not at all."""
    mix = mix_sources(_packed(docs), id_col="_id", text_col="_text", source_col="_source", carry=["_content"])
    plan = mix.filter("copies > 0").select(F.col("_content").alias("_key"), F.col("copies").cast("int").alias("_copies")).distinct()
    taken = _packed(docs).join(plan, F.col("_content") == F.col("_key"))
    return taken.select("_doc", F.explode(F.array_repeat(F.lit(1), F.col("_copies")))).select("_doc.*")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and place in it."""
    return shard_records(docs, carry=[c for c in docs.columns if c != "doc_id"])


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicate),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("sharding", sharding),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = lambda docs, stage: saved(stage[1](spark, docs, sf_dir))
    return reduce(step, STAGES[:-1], table(spark, sf_dir, "documents")).transform(lambda d: STAGES[-1][1](spark, d, sf_dir))
