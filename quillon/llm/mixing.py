"""Mixing sources to target weights by pivotal dependent rounding over a reduction tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import SPACE, saved, table

#: More sources than this are refused: the table of sources is ranked in one task and broadcast.
MAX_SOURCES = 100_000
LEAF_ROWS = 8192
FANOUT = 4096
EPS = 1e-12


def source_targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """(_source, _size) to (_source, _size, _target): weights repeat over the sources in order, null last.

    The whole is the sum of all sizes. A target stops at cap times its source's size; sources are
    taken by cap/weight, so that the ones that stop come first and each is decided by the mass and
    weight that those before it leave.
    """
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int")).cast("long")
    one = ranked.withColumn("_weight", weight).withColumn("_cap", F.col("_size") * cap)
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("_rank"))
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    left = one.select(
        "*",
        (F.sum("_size").over(every) - zero(F.sum("_cap").over(before))).alias("_mass"),
        (F.sum("_weight").over(every) - zero(F.sum("_weight").over(before))).alias("_rest"),
    ).withColumn("_full", F.col("_mass").cast("double") * F.col("_weight") >= F.col("_cap").cast("double") * F.col("_rest"))
    some = left.select(
        "*",
        (F.sum("_size").over(every) - zero(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(every))).alias("_free"),
        zero(F.sum(F.when(~F.col("_full"), F.col("_weight"))).over(every)).alias("_shared"),
    )
    share = F.col("_free").cast("double") * F.col("_weight") / F.col("_shared")
    return some.select("_source", "_size", F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(share).alias("_target"))


def pivot(size: np.ndarray, p: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, int]:
    """Rounds the probabilities p in turn; sum(size * p) stays. Returns them and the index still fractional, or -1.

    Two fractional entries play: mass moves from one to the other, in words, until one of the two
    is 0 or 1. The direction is drawn so that each entry's expectation stays as it was.
    """
    p, holder = p.astype(float), -1
    for j in range(len(p)):
        if p[j] <= EPS or p[j] >= 1 - EPS:
            p[j] = round(p[j])
            continue
        if holder < 0:
            holder = j
            continue
        a, b = float(size[holder]), float(size[j])
        up, down = min(1 - p[holder], p[j] * b / a), min(p[holder], (1 - p[j]) * b / a)
        move = up if u[j] * (up + down) < down else -down
        p[holder] += move
        p[j] -= move * a / b
        open_h, open_j = EPS < p[holder] < 1 - EPS, EPS < p[j] < 1 - EPS
        for k, still in ((holder, open_h), (j, open_j)):
            if not still:
                p[k] = round(p[k])
        holder = holder if open_h else j if open_j else -1
    return p, holder


def _play(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["_size", "_draw"], ascending=[False, True], kind="stable", ignore_index=True)
    p, holder = pivot(group["_size"].to_numpy(), group["_p"].to_numpy(), group["_u"].to_numpy())
    open_ = np.zeros(len(group), bool)
    open_[holder if holder >= 0 else slice(0, 0)] = True
    return group.assign(_p=p, _open=open_)


def _play_sorted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """_play for each (_group, _node) of a partition sorted by them; groups have some LEAF_ROWS rows."""
    kept: pd.DataFrame | None = None
    for batch in batches:
        both = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
        groups = [g for _, g in both.groupby(["_group", "_node"], sort=False)]
        if groups:
            kept = groups[-1]
            done = [_play(g) for g in groups[:-1]]
            if done:
                yield pd.concat(done, ignore_index=True)
    if kept is not None and len(kept):
        yield _play(kept)


_SCHEMA = "_row long, _group int, _node long, _size long, _p double, _u double, _draw long, _open boolean"


def _level(rows: DataFrame, seed: int, level: int) -> DataFrame:
    draw = F.xxhash64("_row", F.lit(seed), F.lit(level))
    ready = rows.select(
        "_row", "_group", "_node", "_size", "_p",
        (F.shiftrightunsigned(draw, 11).cast("double") * F.lit(2.0**-53)).alias("_u"),
        draw.alias("_draw"),
        F.lit(False).alias("_open"),
    )
    return ready.repartition("_group", "_node").sortWithinPartitions("_group", "_node").mapInPandas(_play_sorted, _SCHEMA)


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    cap: int = 3,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per document: id, size, source_size, target, copies, taken, and the columns named in carry.

    size is the number of words; copies is how often the mix repeats the document, taken is
    copies * size. A source's documents share the rate target / source_size: its whole part is
    given to each, its fraction is rounded by pivotal sampling that keeps the sum of words. A
    source is cut by a hash of the row into leaves of some LEAF_ROWS rows, each leaf leaves one
    fractional document at most, and those meet again over FANOUT leaves at a time until one per
    source is left, which is rounded to the nearer side: a source's words miss its target by half
    of one document at most. The hash of id and text seeds every draw, so reruns agree.

    A null text has size 0. A null source is a source of its own, last in order. Documents of size 0
    take nothing and get the whole part of the rate as copies. Rows of a source that repeat id and text
    are decided together, as one document of their common size. Other columns of the input are not read. An empty table gives an empty
    result.
    """
    words = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")
    row = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    carried = F.struct(*[F.col(c) for c in carry or [id_col]]).alias("_carried")
    rows = saved(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), words.alias("_size"), row.alias("_row"), carried))
    sources = saved(rows.groupBy("_source").agg(F.sum("_size").alias("_size"), F.count(F.lit(1)).alias("_n")))
    if sources.count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    targets = source_targets(sources.select("_source", "_size"), weights, cap)
    rate = F.when(F.col("_size") > 0, F.col("_target") / F.col("_size")).otherwise(0.0)
    plan = saved(
        targets.join(sources.select("_source", "_n"), targets["_source"].eqNullSafe(sources["_source"]))
        .select(
            targets["_source"].alias("_s"),
            F.col("_size").alias("_total"),
            "_target",
            F.least(F.floor(rate + EPS), F.lit(cap)).cast("int").alias("_whole"),
            F.greatest(rate - F.floor(rate + EPS), F.lit(0.0)).alias("_rate"),
            F.ceil(F.col("_n") / LEAF_ROWS).cast("long").alias("_leaves"),
        )
        .withColumn("_group", (F.row_number().over(Window.orderBy(F.col("_s").asc_nulls_last()))).cast("int"))
    )
    keyed = rows.join(F.broadcast(plan), rows["_source"].eqNullSafe(plan["_s"]))
    entries = (
        keyed.filter((F.col("_size") > 0) & (F.col("_rate") > EPS))
        .groupBy("_row", "_group", "_leaves")
        .agg(F.sum("_size").alias("_size"), F.first("_rate").alias("_p"))
        .withColumn("_node", F.pmod(F.xxhash64("_row", F.lit(seed)), F.col("_leaves")))
    )
    played = saved(_level(entries, seed, 0))
    settled = [played.filter(~F.col("_open"))]
    up = played.filter("_open")
    for level in (1, 2, 3):
        up = saved(_level(up.withColumn("_node", F.floor(F.col("_node") / FANOUT)), seed, level))
        settled.append(up.filter(~F.col("_open")))
        up = up.filter("_open")
    settled.append(up.withColumn("_p", F.round("_p")))
    won = settled[0]
    for more in settled[1:]:
        won = won.unionByName(more)
    won = won.filter(F.col("_p") >= 0.5).select(F.col("_row").alias("_r"), F.col("_group").alias("_g"))
    copies = F.col("_whole") + F.when(F.col("_r").isNotNull(), 1).otherwise(0)
    return (
        keyed.join(won, (F.col("_row") == F.col("_r")) & (F.col("_group") == F.col("_g")), "left")
        .select(
            F.col("_id").alias(id_col),
            F.col("_size").alias("size"),
            F.col("_total").alias("source_size"),
            F.col("_target").alias("target"),
            copies.cast("long").alias("copies"),
            (copies * F.col("_size")).cast("long").alias("taken"),
            *[F.col("_carried").getField(c).alias(c) for c in carry or []],
        )
    )


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    got = mix_sources(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "source_size", "target", "taken", "copies")
