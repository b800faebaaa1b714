"""Review log: replay with undo, effective labels, published rows, training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import DECISIONS, REVIEW_STATUS
from .ensemble import confidence_score


def _matched(events: DataFrame, key: str, order: tuple[str, ...]):
    """(events that hold, all on their key's stack; the window from the end of the log)."""
    back = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    later = back.rowsBetween(Window.unboundedPreceding, -1)
    step = F.when(F.col("action") == "set", -1).otherwise(1)
    summed = events.withColumn("_run", F.coalesce(F.sum(step).over(later), F.lit(0)))
    owed = F.col("_run") - F.least(F.lit(0), F.min("_run").over(back.rowsBetween(Window.unboundedPreceding, 0)))
    return summed.withColumn("_owed", owed).filter((F.col("action") == "set") & (F.col("_owed") == 0)).drop("_run", "_owed"), back


def standing(events: DataFrame, key: str = "utterance_id", order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """The sets that no undo has taken back: what is on each key's stack.

    They stand for the whole log up to its end: with later events added, they replay to what the whole log does, as an undo takes back the latest set that stands.
    """
    return _matched(events, key, order)[0]


def replay(events: DataFrame, key: str = "utterance_id", order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """The event that holds for each key after all its sets and undos; keys without one are absent.

    Any action other than "set" takes back the latest set that still holds, if there is one. Read
    from the end of the log, that is bracket matching: the undos that are still owed a set are a sum that
    stops at 0, and the first set that meets none is the one that holds. One shuffle by key, one sort, running
    sums only.
    """
    free, back = _matched(events, key, order)
    return free.withColumn("_nth", F.row_number().over(back)).filter("_nth = 1").drop("_nth")


def review_offset(events: DataFrame) -> DataFrame:
    """The next sequence number: one row."""
    return events.agg(F.coalesce(F.max("seq") + 1, F.lit(0)).cast("long").alias("review_offset"))


def effective(labels: DataFrame, current: DataFrame, key: str = "utterance_id") -> DataFrame:
    """labels with reviewed, review_decision, effective_transcript and source. current has key, decision and transcript."""
    said = current.select(F.col(key).alias("_key"), F.lit(True).alias("_seen"), F.col("decision").alias("_decision"), F.col("transcript").alias("_text"))
    seen = F.coalesce("_seen", F.lit(False))
    text = F.when(~seen, F.col("transcript")).when(F.col("_decision") == "edit", F.col("_text")).when(F.col("_decision") == "accept", F.col("transcript"))
    source = F.when(~seen, "model").when(F.col("_decision") == "accept", "human-confirmed").otherwise("human")
    joined = labels.join(said, labels[key] == said["_key"], "left")
    return joined.select(
        *[labels[c] for c in labels.columns], seen.alias("reviewed"), F.col("_decision").alias("review_decision"),
        text.otherwise("").alias("effective_transcript"), source.alias("source"),
    )


def review_status(decision: Column) -> Column:
    """auto without a decision; an unknown decision stops the query."""
    out = F.when(decision.isNull(), "auto")
    for name, status in REVIEW_STATUS.items():
        out = out.when(decision == name, status)
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown decision "), decision)).cast("string"))


def published_confidence(rows: DataFrame) -> Column:
    decision = F.col("review_decision")
    fresh = confidence_score(F.col("agreement_score"), F.col("rover_confidence"), F.col("advisory_disagree"))
    kept = F.coalesce("confidence", fresh) if "confidence" in rows.columns else fresh
    return F.when(decision.isin("accept", "edit", "non_speech"), 1.0).when(decision == "reject", 0.0).otherwise(kept)


def published(rows: DataFrame, *carry: str) -> DataFrame:
    """Effective labels as they are published, and the columns named."""
    return rows.select(
        *carry, "utterance_id", F.col("effective_transcript").alias("transcript"), published_confidence(rows).alias("confidence"),
        review_status(F.col("review_decision")).alias("review_status"), "agreement_score", "rover_confidence", "advisory_disagree",
        F.col("n_models_agree").cast("long").alias("n_models_agree"), "callsign_matched", "callsign_tail",
    )


def training_rows(rows: DataFrame, tiers: tuple[str, ...] = ("gold", "silver"), *carry: str) -> DataFrame:
    """Accepted and edited rows, and unreviewed ones of the tiers, that have a transcript; and the columns named."""
    wanted = F.when(F.col("reviewed"), F.col("review_decision").isin("accept", "edit")).otherwise(F.col("tier").isin(*tiers))
    return rows.filter(wanted & (F.col("effective_transcript") != "")).select(
        *carry, "utterance_id", F.col("effective_transcript").alias("transcript"), "tier", "source", "reviewed", "agreement_score", "rover_confidence"
    )


def check_decision(decision: str) -> str:
    if decision not in DECISIONS:
        raise ValueError(f"decision is one of {', '.join(DECISIONS)}")
    return decision
