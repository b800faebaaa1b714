"""An event log for many writers: numbered segments, each created by exactly one of them."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import REVIEWS
from ..sources.jsonl import read_jsonl
from ..sources.shards import file_names
from .files import create_only, read_text

_NAME = "{:019d}.jsonl"


class EventLog:
    """Events in a shared folder, numbered by seq from 0 without a gap.

    A segment is a file named by the seq of its first event. It is written whole under another name and then created under its own, which exactly one
    writer can do: by a hard link on a local file system, by a rename that never replaces on others (a file system whose rename replaces, as those over
    object stores may, is not for this). A writer that finds its number taken reads the new end and tries again, so two writers at once lose no event and repeat no number, and
    no lock is held anywhere. Readers see whole segments only, in one order.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str = REVIEWS, tries: int = 100):
        self.spark, self.folder, self.schema, self.tries = spark, folder, schema, tries

    def _segments(self) -> list[tuple[int, str]]:
        """(first seq, path) in order; other files of the folder are no segments."""
        named = ((p.rpartition("/")[2].removesuffix(".jsonl"), p) for p in file_names(self.spark, self.folder, "*.jsonl"))
        return sorted((int(n), p) for n, p in named if n.isdigit())

    def next_seq(self) -> int:
        """The number after the last event: from the names, and the length of the last segment alone."""
        found = self._segments()
        if not found:
            return 0
        first, path = found[-1]
        return first + read_text(self.spark, path).count("\n")

    def append(self, events: list[dict], check: Callable[[int], None] | None = None) -> int:
        """Adds events as one segment, all or none, and gives the seq of the first. A seq in them is set here. check(seq) may raise before a try."""
        if not events:
            raise ValueError("a segment has one event at least")
        pause = 0.001
        for _ in range(self.tries):
            first = self.next_seq()
            if check is not None:
                check(first)
            lines = "".join(json.dumps(e | {"seq": first + i}) + "\n" for i, e in enumerate(events))
            if create_only(self.spark, f"{self.folder}/{_NAME.format(first)}", lines.encode()):
                return first
            time.sleep(pause * (0.5 + uuid.uuid4().int % 1000 / 1000))  # writers that met do not meet again at once
            pause = min(2 * pause, 0.2)
        raise TimeoutError(f"no free number in {self.tries} tries: {self.folder}")

    def read(self, since: int = 0) -> DataFrame:
        """The events with a seq of since or more; segments that end before are not opened."""
        found = self._segments()
        starts = [first for first, _ in found]
        kept = [path for i, (_, path) in enumerate(found) if i + 1 == len(found) or starts[i + 1] > since]
        if not kept:
            return self.spark.createDataFrame([], self.schema)
        return read_jsonl(self.spark, kept, self.schema).filter(F.col("seq") >= since)
