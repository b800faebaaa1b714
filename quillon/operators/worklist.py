"""Review work: ordered queue, its counts, and the stratified plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.alignment import stable_rank
from ..session import numbered, saved

BUDGET = 1000
GOLD = 50
BINS = 10
#: The edge between silver and tail, and what counts as near it or as disputed.
EDGE, NEAR, DISPUTED = 0.3, 0.1, 0.5

ITEM = ("utterance_id", "tier", "rover_confidence", "agreement_score", "n_models_agree", "callsign_matched", "advisory_disagree", "shard")


def flag_reviewed(labels: DataFrame, reviewed: DataFrame, key: str = "utterance_id") -> DataFrame:
    """labels with reviewed: whether the key is among the reviewed ones."""
    ids = reviewed.select(F.col(key).alias("_key")).distinct().withColumn("_seen", F.lit(True))
    return labels.join(ids, labels[key] == ids["_key"], "left").withColumn("reviewed", F.coalesce("_seen", F.lit(False))).drop("_key", "_seen")


def dispute(c: str = "advisory_disagree") -> Column:
    return F.coalesce(F.col(c), F.lit(0.0))


def review_queue(labels: DataFrame, tie: str = "pos") -> DataFrame:
    """Silver and tail labels with their position: by shard, most disputed first, then least agreed, then as they came."""
    rows = labels.filter(F.col("tier").isin("silver", "tail"))
    return numbered(rows, F.col("shard"), dispute().desc(), F.col("agreement_score"), F.col(tie))


def queue_counts(labels: DataFrame) -> DataFrame:
    """One row: total, reviewed and remaining of silver and tail together and each; zero where there are none."""
    open_ = F.col("tier").isin("silver", "tail")
    named = [("", open_), ("silver_", F.col("tier") == "silver"), ("tail_", F.col("tier") == "tail")]
    cols = []
    for prefix, rows in named:
        cols += [
            F.count_if(rows).alias(f"{prefix}total"), F.count_if(rows & F.col("reviewed")).alias(f"{prefix}reviewed"),
            F.count_if(rows & ~F.col("reviewed")).alias(f"{prefix}remaining"),
        ]
    return labels.agg(*cols)


def score_bin(score: Column) -> Column:
    return F.least(F.lit(BINS - 1), F.greatest(F.lit(0), (score * float(BINS)).cast("int")))


def gold_validation(pool: DataFrame, most: int = GOLD) -> DataFrame:
    """The first gold rows by rank, a fixed set; then without those that are reviewed. Columns: utterance_id, place."""
    first = pool.filter(F.col("tier") == "gold").orderBy("_rank", "utterance_id").limit(most)
    kept = first.filter(~F.col("reviewed"))
    return kept.select("utterance_id", F.row_number().over(Window.orderBy("_rank", "utterance_id")).alias("place"))


def calibration(pool: DataFrame, most: int) -> DataFrame:
    """Rows from BINS equal bins of the score in turn, each bin by rank. Columns: utterance_id, place.

    A bin gives most rows at best, so each task keeps no more of it, and the turns are over
    BINS * most rows.
    """
    bin_ = score_bin(F.col("agreement_score"))
    each = Window.partitionBy("_bin").orderBy("_rank", "utterance_id")
    dealt = pool.filter(F.col("tier").isin("gold", "silver", "tail")).withColumn("_bin", bin_).withColumn("_turn", F.row_number().over(each))
    first = dealt.filter(F.col("_turn") <= most).orderBy("_turn", "_bin").limit(most)
    return first.select("utterance_id", F.row_number().over(Window.orderBy("_turn", "_bin")).alias("place"))


def boundary(pool: DataFrame, most: int) -> DataFrame:
    """Rows near the edge of silver, and disputed gold and silver ones; nearest first. Columns: utterance_id, place."""
    near = F.abs(F.col("agreement_score") - EDGE) <= NEAR
    rows = pool.filter(near | (F.col("tier").isin("gold", "silver") & (dispute() >= DISPUTED)))
    order = [F.abs(F.col("agreement_score") - EDGE), dispute().desc(), F.col("_rank"), F.col("utterance_id")]
    return rows.orderBy(*order).limit(most).select("utterance_id", F.row_number().over(Window.orderBy(*order)).alias("place"))


def review_plan(labels: DataFrame, budget: int = BUDGET, rank: Callable[[Column], Column] = stable_rank) -> DataFrame:
    """(utterance_id, reason, position): gold validation, then boundary and calibration in turn.

    labels has reviewed (flag_reviewed). The gold rows are beside the budget. Calibration is half of the budget,
    less the gold rows among it; the boundary fills the rest and holds neither. Each stratum is a top-k, so
    what meets in one task has budget rows at most.
    """
    pool = saved(labels.filter(F.col("tier") != "non_speech").withColumn("_rank", rank(F.col("utterance_id"))))
    gold = gold_validation(pool)
    dealt = calibration(pool, budget // 2).join(gold.select("utterance_id"), "utterance_id", "left_anti")
    cal = dealt.select("utterance_id", F.row_number().over(Window.orderBy("place")).alias("place"))
    rest = pool.join(gold.select("utterance_id"), "utterance_id", "left_anti").join(cal.select("utterance_id"), "utterance_id", "left_anti")
    left = cal.agg((F.lit(budget) - F.count(F.lit(1))).alias("_left"))
    edge = boundary(rest, budget).filter(F.col("place") <= left.scalar())
    named = [
        part.select("utterance_id", F.lit(reason).alias("reason"), F.lit(late).alias("_late"), "place", F.lit(after).alias("_after"))
        for part, reason, late, after in ((gold, "gold-validation", 0, 0), (edge, "boundary", 1, 0), (cal, "calibration", 1, 1))
    ]
    all_ = named[0].unionByName(named[1]).unionByName(named[2])
    return all_.select("utterance_id", "reason", F.row_number().over(Window.orderBy("_late", "place", "_after")).alias("position"))


def plan_items(labels: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan's rows with the columns that reviewers see."""
    return plan.join(labels.select(*ITEM, "reviewed"), "utterance_id")
