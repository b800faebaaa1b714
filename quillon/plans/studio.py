"""Review sessions: a method for each request that the review desk makes."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.context import SPAN, epoch_seconds, group_tracks, review_context, split_key
from ..operators.review import check_decision, effective, replay, review_offset, standing
from ..operators.worklist import BUDGET, flag_reviewed, plan_items, queue_counts, review_plan, review_queue
from ..schemas import REVIEWS
from ..session import saved
from ..sinks.eventlog import EventLog
from ..sinks.files import read_text, write_text


class Studio:
    """labels (with shard and pos), meta, events and, if there is one, the source table with audio and tracks.

    With a folder, events live in a log there (EventLog) that any number of desks may write to at once; events that are given are those from before the log, and
    keep numbers below 0 there. Without one, events that are recorded are kept by this desk alone. Between requests a desk keeps, as a saved table, the sets that stand up to a seq;
    a request reads that table and the log's segments from that seq on, not the log.
    """

    def __init__(self, labels: DataFrame, meta: DataFrame, events: DataFrame, source: DataFrame | None = None, folder: str | None = None, reviewer: str | None = None):
        self.labels, self.meta, self.source, self.reviewer = labels, meta, source, reviewer
        self.log = EventLog(labels.sparkSession, folder) if folder else None
        if self.log:  # events from before the log come before all of it
            events = events.withColumn("seq", F.col("seq") - F.lit(1 << 62))
        self._base, self._upto, self.events = None, 0, events

    def refresh(self) -> int:
        """Brings the saved table up to the log's end: what stands of it and of the events since. The seq that it holds up to."""
        if self.log is None:
            return self._upto
        end = self.log.next_seq()
        if self._base is None or end > self._upto:
            before = self._base if self._base is not None else self.events
            added = self.log.read(self._upto).filter(F.col("seq") < end)
            self._base, self._upto = saved(standing(before.unionByName(added.select(*before.columns)))), end
        return self._upto

    def current(self) -> DataFrame:
        self.refresh()
        return replay(self.events if self._base is None else self._base)

    def _flagged(self) -> DataFrame:
        return flag_reviewed(self.labels, self.current().select("utterance_id"))

    def queue(self) -> DataFrame:
        return review_queue(self._flagged())

    def pin_queue(self, folder: str, page_rows: int = 1000) -> None:
        """Saves the queue's order as it is now, page_rows items a file: what pages() reads, whatever verdicts come in later."""
        pinned = self.queue().drop("reviewed").withColumn("_page", F.floor((F.col("position") - 1) / page_rows).cast("int"))
        pinned.repartition("_page").sortWithinPartitions("_page", "position").write.mode("overwrite").partitionBy("_page").parquet(folder)
        write_text(self.labels.sparkSession, f"{folder}/_page_rows", str(page_rows))

    def page(self, folder: str, after: int = 0, size: int = 50) -> DataFrame:
        """The size items of a pinned queue after a position, in order, with reviewed as it is now. The last position of a page is where the next begins.

        Only the files that hold those positions are read: their numbers follow from the cursor.
        """
        page_rows = int(read_text(self.labels.sparkSession, f"{folder}/_page_rows"))
        pinned = self.labels.sparkSession.read.parquet(folder)
        files = F.col("_page").between(after // page_rows, (after + size - 1) // page_rows)
        rows = pinned.filter(files & (F.col("position") > after) & (F.col("position") <= after + size)).drop("_page")
        return flag_reviewed(rows, self.current().select("utterance_id")).orderBy("position")

    def plan(self, budget: int = BUDGET) -> DataFrame:
        rows = self._flagged()
        return plan_items(rows, review_plan(rows, budget))

    def queue_totals(self) -> DataFrame:
        """One row: total, the items of the queue; reviewed, all keys with a verdict, those outside the queue too."""
        total = self.labels.agg(F.count_if(F.col("tier").isin("silver", "tail")).alias("total"))
        return total.crossJoin(self.current().agg(F.count_distinct("utterance_id").alias("reviewed")))  # a row each

    def plan_totals(self, budget: int = BUDGET) -> DataFrame:
        """One row: total, the items of the plan; reviewed, those of them with a verdict."""
        return self.plan(budget).agg(F.count(F.lit(1)).alias("total"), F.count_if("reviewed").alias("reviewed"))

    def stats(self) -> DataFrame:
        return queue_counts(self._flagged())

    def context(self, utterance_id: str) -> DataFrame:
        """One row, or none where the label or its meta is missing; with neighbours, and times and tracks if there is a source."""
        one = review_context(effective(self.labels.filter(F.col("utterance_id") == utterance_id), self.current()), self.meta)
        prefix, position = split_key(F.lit(utterance_id))
        names = F.transform(F.sequence(F.lit(-SPAN), F.lit(SPAN)), lambda d: F.concat_ws("/", prefix, (position + d).cast("string")))
        rows = self.labels.select("utterance_id", "transcript", "tier")
        asked = self.labels.sparkSession.range(1).select(F.posexplode(F.coalesce(names, F.array().cast("array<string>"))).alias("_nth", "utterance_id"))
        start = F.lit(None).cast("double").alias("start")
        if self.source is not None:
            rows = rows.join(self.source.select("utterance_id", epoch_seconds(F.col("start")).alias("_start")), "utterance_id", "left")
            start = F.col("_start").alias("start")
            extra = self.source.filter(F.col("utterance_id") == utterance_id).select(
                "utterance_id", epoch_seconds(F.col("start")).alias("start"), epoch_seconds(F.col("end")).alias("end"), "duration_s", "n_aircraft", "clip_offset_s",
                group_tracks(F.col("tracks")).alias("tracks"),
            )
            one = one.join(extra, "utterance_id", "left")
        cell = F.struct("utterance_id", "transcript", "tier", (F.col("utterance_id") == utterance_id).alias("current"), start)
        near = rows.join(F.broadcast(asked), "utterance_id").agg(F.array_sort(F.collect_list(F.struct("_nth", cell.alias("c")))).alias("_near"))
        return one.crossJoin(near).withColumn("conversation", F.transform("_near", lambda x: x["c"])).drop("_near")

    def audio(self, utterance_id: str) -> bytes:
        row = None if self.source is None else self.source.filter(F.col("utterance_id") == utterance_id).select("audio.bytes").first()
        if row is None:
            raise KeyError(utterance_id)
        return bytes(row["bytes"] or b"")

    def _append(self, utterance_id: str, action: str, decision: str | None, transcript: str | None, base_hyp: str | None) -> dict:
        found = self.labels.filter(F.col("utterance_id") == utterance_id).select("shard").first()
        if found is None:
            raise KeyError(utterance_id)
        row = {
            "utterance_id": utterance_id, "action": action, "seq": 0, "ts": time.time(), "shard": int(found["shard"]), "reviewer": self.reviewer, "decision": decision,
            "transcript": transcript, "base_hyp": base_hyp,
        }
        if self.log:
            row["seq"] = self.log.append([row])
        else:
            row["seq"] = review_offset(self.events).first()["review_offset"]
            event = self.labels.sparkSession.createDataFrame([tuple(row.values())], REVIEWS)
            self.events = self.events.select(*event.columns).unionByName(event)
        return row

    def record(self, utterance_id: str, decision: str, transcript: str, base_hyp: str) -> dict:
        """Adds a verdict; an unknown decision or utterance raises before anything is written."""
        return self._append(utterance_id, "set", check_decision(decision), transcript, base_hyp)

    def undo(self, utterance_id: str) -> dict | None:
        """Takes back the latest verdict and gives the one that holds then. Without a verdict nothing is recorded."""
        holds = self.current().filter(F.col("utterance_id") == utterance_id)
        if holds.head(1):
            self._append(utterance_id, "undo", None, None, None)
        row = self.current().filter(F.col("utterance_id") == utterance_id).first()
        return row.asDict() if row else None
