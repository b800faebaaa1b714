"""What a reviewer sees of a clip: neighbours, tracks of aircraft, aligned hypotheses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.alignment import diff_ops

SPAN = 3

#: The label columns of a context.
SHOWN = (
    "utterance_id", "transcript", "tier", "rover_confidence", "agreement_score", "n_models_agree", "n_tails", "callsign_matched", "callsign_tail",
    "callsign_score", "snapped", "advisory_disagree",
)


def split_key(key: Column) -> tuple[Column, Column]:
    """(prefix, position) of "prefix/number"; the position is null where what follows the last slash is no number."""
    last = F.regexp_extract(key, "([^/]*)$", 1)
    prefix = F.when(key.contains("/"), F.regexp_extract(key, "^(.*)/[^/]*$", 1)).otherwise("")
    return prefix, F.when(last.rlike("^[0-9]+$"), last.cast("long"))


def conversation_window(rows: DataFrame, prefix: str, position: str, cell: Column, span: int = SPAN, name: str = "conversation") -> DataFrame:
    """rows with the cells of rows of the same prefix within span positions, by position. Gaps do not widen it."""
    near = Window.partitionBy(prefix).orderBy(position).rangeBetween(-span, span)
    return rows.withColumn(name, F.collect_list(F.struct(F.col(position).alias("_p"), cell.alias("_c"))).over(near)).withColumn(
        name, F.transform(F.array_sort(name), lambda x: x["_c"])
    )


def neighbours(rows: DataFrame, prefix: str, position: str, span: int = SPAN) -> DataFrame:
    """A row for each pair of rows of a prefix within span positions, as an equi-join: 2 * span + 1 rows a row at most.

    Unlike a window it needs no prefix in one task, so a conversation of any length is spread over all.
    Columns: all of rows, and neighbour and offset.
    """
    here = rows.withColumn("_off", F.explode(F.sequence(F.lit(-span), F.lit(span)))).withColumn("_at", F.col(position) + F.col("_off"))
    there = rows.select(F.col(prefix).alias("_p"), F.col(position).alias("_q"))
    met = here.join(there, (F.col(prefix) == F.col("_p")) & (F.col("_at") == F.col("_q")))
    return met.select(*rows.columns, F.col("_q").alias("neighbour"), F.col("_off").alias("offset"))


def epoch_seconds(t: Column) -> Column:
    """Seconds since 1970 of a time without zone, taken as UTC (the session's zone)."""
    return F.unix_micros(t.cast("timestamp")) / 1e6


def group_tracks(points: Column) -> Column:
    """Track points by aircraft, in the order in which aircraft first appear, each by time with null times last. No shuffle.

    The key of a point is its aircraft_id, or its tail, or "". No points give an empty array.
    """
    key = lambda p: F.coalesce(F.nullif(p["aircraft_id"], F.lit("")), F.nullif(p["tail"], F.lit("")), F.lit(""))
    shaped = lambda p: F.struct(epoch_seconds(p["t"]).alias("t"), *[p[c].alias(c) for c in ("lat", "lon", "alt", "speed", "heading")])
    sooner = lambda a, b: F.when(a["n"] < b["n"], -1).when(a["n"] > b["n"], 1).when(a["t"] < b["t"], -1).when(a["t"] > b["t"], 1).when(a["i"] < b["i"], -1).otherwise(1)

    def one(k: Column) -> Column:
        own = F.filter(points, lambda p: key(p) == k)
        first = F.get(own, F.lit(0))
        placed = F.transform(own, lambda p, i: F.struct(p["t"].isNull().cast("int").alias("n"), p["t"].alias("t"), i.alias("i"), shaped(p).alias("p")))
        sorted_ = F.transform(F.array_sort(placed, sooner), lambda x: x["p"])
        return F.struct(first["tail"].alias("tail"), first["aircraft_id"].alias("aircraft_id"), sorted_.alias("points"))

    none = F.filter(F.transform(F.array(F.lit("")), one), lambda x: F.lit(False))
    return F.when(F.size(points) > 0, F.transform(F.array_distinct(F.transform(points, key)), one)).otherwise(none)


def map_points(tracks: Column) -> Column:
    """Tracks with the points that have a place only, and the last of them as marker."""
    located = lambda t: F.filter(t["points"], lambda p: p["lat"].isNotNull() & p["lon"].isNotNull())
    return F.transform(
        tracks, lambda t: F.struct(t["tail"].alias("tail"), t["aircraft_id"].alias("aircraft_id"), located(t).alias("points"), F.try_element_at(located(t), F.lit(-1)).alias("marker"))
    )


def review_context(effective: DataFrame, meta: DataFrame) -> DataFrame:
    """A row for each effective label with meta: the shown columns, hypotheses aligned to the transcript, airport, tails, verdict."""
    about = meta.select(F.col("utterance_id").alias("_key"), "airport", F.coalesce("tails", F.array().cast("array<string>")).alias("tails"))
    rows = effective.join(about, effective["utterance_id"] == about["_key"]).drop("_key")
    each = rows.select("utterance_id", "transcript", F.posexplode_outer("voting_text").alias("_nth", "_text"))
    ops = each.filter(F.col("_text").isNotNull()).withColumn("_ops", diff_ops(F.col("transcript"), F.col("_text")))
    aligned = ops.groupBy("utterance_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_nth", F.struct(F.col("_text").alias("text"), F.col("_ops").alias("ops")).alias("a")))), lambda x: x["a"]).alias("aligned_hypotheses")
    )
    shown = [c for c in SHOWN if c in rows.columns]
    return rows.join(aligned, "utterance_id", "left").select(
        *shown, F.col("transcript").alias("base_hyp"), "voting_text", "aligned_hypotheses", "airport", "tails", "reviewed", "review_decision",
        "effective_transcript", "source",
    )


def decided_transcript(decision: Column, base_hyp: Column, draft: Column) -> Column:
    """What a decision says the transcript is."""
    return F.when(decision == "accept", base_hyp).when(decision == "edit", draft).otherwise("")
