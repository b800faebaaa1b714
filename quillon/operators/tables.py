"""Joins and set operations over keyed tables: voters, advisory, last row wins, pending work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_wins(rows: DataFrame, keys: list[str], order: str = "pos") -> DataFrame:
    """One row a key: the last by order, at the place of the first. Rows fold before the shuffle."""
    cols = [c for c in rows.columns if c not in keys]
    whole = F.struct(F.col(order).alias("_o"), F.struct(*cols).alias("_r"))
    packed = rows.select(*keys, whole.alias("_w")).groupBy(*keys)
    kept = packed.agg(F.max_by(F.col("_w._r"), F.col("_w._o")).alias("_r"), F.min("_w._o").alias("_first"))
    return kept.select(*keys, *[(F.col("_first") if c == order else F.col(f"_r.{c}")).alias(c) for c in cols])


def join_voters(meta: DataFrame, hyps: DataFrame, voters: list[str], advisory: str | None = None, keys: tuple[str, ...] = ("utterance_id",)) -> DataFrame:
    """meta with voting (array<struct<text, no_speech>> in the order of voters) for utterances that all voters have.

    hyps has a row for each (key, model). One grouped pass stands for the chain of inner joins: a
    single shuffle whatever the number of voters. With an advisory, _advisory is its hypothesis, or null
    where it has no row; that it has one, not its text, is what counts.
    """
    named = [*voters, *([advisory] if advisory else [])]
    cell = F.struct(F.coalesce("text", F.lit("")).alias("text"), "no_speech")
    picks = [F.max_by(F.when(F.col("model") == m, cell), F.when(F.col("model") == m, F.lit(1))).alias(f"_v{i}") for i, m in enumerate(named)]
    wide = hyps.filter(F.col("model").isin(named)).groupBy(*keys).agg(*picks)
    whole = wide
    for i in range(len(voters)):
        whole = whole.filter(F.col(f"_v{i}").isNotNull())
    voting = whole.select(
        *keys, F.array(*[F.col(f"_v{i}") for i in range(len(voters))]).alias("voting"),
        *([F.col(f"_v{len(voters)}").alias("advisory")] if advisory else []),
    )
    return meta.join(voting, list(keys))


def shard_counts(meta: DataFrame, labelled: DataFrame) -> DataFrame:
    """(shard, labelled, skipped): utterances of a shard that have all voters, and those that lack one."""
    both = meta.groupBy("shard").agg(F.count(F.lit(1)).alias("all")).join(labelled.groupBy("shard").agg(F.count(F.lit(1)).alias("labelled")), "shard", "left")
    return both.select("shard", F.coalesce("labelled", F.lit(0)).alias("labelled"), (F.col("all") - F.coalesce("labelled", F.lit(0))).alias("skipped"))


def pending(asked: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """What was asked for and has no output yet, by keys (the shard, if none are named)."""
    by = list(keys or ("shard",))
    return asked.select(*by).distinct().join(done.select(*by), by, "left_anti")


def duration_buckets(clips: DataFrame, duration: str, size: int, *ties: str) -> DataFrame:
    """clips with bucket: consecutive runs of size clips by duration."""
    from ..session import numbered

    placed = numbered(clips, F.col(duration), *[F.col(t) for t in ties], name="_nth")
    return placed.withColumn("bucket", F.floor((F.col("_nth") - 1) / size)).drop("_nth")


def replica_of(shards: DataFrame, replicas: int, key: str = "shard") -> DataFrame:
    """(shard, replica): pending shards dealt in turn. Shards are few: a number for each file."""
    return shards.select(key, ((F.row_number().over(Window.orderBy(key)) - 1) % replicas).alias("replica"))


def next_unreviewed(queue: DataFrame, start: int, position: str = "position") -> DataFrame:
    """The first item that is not reviewed at or after start, wrapping to the front; no row if all are."""
    ahead: Column = F.when(F.col(position) >= start, 0).otherwise(1)
    return queue.filter(~F.col("reviewed")).orderBy(ahead, position).limit(1)
