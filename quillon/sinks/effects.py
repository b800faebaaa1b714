"""A log of effects: what tasks have got from outside, written down as they get it, so that a broken run is not paid for twice."""

from __future__ import annotations

import json
import time
import uuid
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.jsonl import read_jsonl_recoverable
from ..sources.shards import file_system
from .files import delete

_ROWS = "shard int, utterance_id string, answer string, at long"


class LogWriter:
    """One attempt of a task: its own segment files, a line an effect, flushed before put() returns. Threads may share it."""

    def __init__(self, folder: str, segment_rows: int):
        self._fs, self._root = file_system(folder)
        self._fs.create_dir(self._root, recursive=True)
        self._attempt, self._segment, self._rows, self._limit, self._out, self._lock = uuid.uuid4().hex, 0, 0, segment_rows, None, Lock()

    def put(self, shard: int, utterance_id: str, answer: str) -> None:
        line = json.dumps({"shard": shard, "utterance_id": utterance_id, "answer": answer, "at": time.time_ns()}) + "\n"
        with self._lock:
            if self._out is None:
                self._out = self._fs.open_output_stream(f"{self._root}/{self._attempt}-{self._segment:06d}.jsonl")
            self._out.write(line.encode())
            self._out.flush()
            self._rows += 1
            if self._rows == self._limit:
                self._close()

    def _close(self) -> None:
        if self._out is not None:
            self._out.close()
            self._out, self._rows, self._segment = None, 0, self._segment + 1

    def __enter__(self) -> LogWriter:
        return self

    def __exit__(self, *_) -> None:
        with self._lock:
            self._close()


class EffectLog:
    """Answers by (shard, utterance_id), in a folder that all executors share.

    Each attempt of a task writes files of its own, so no two writers meet, and a file holds segment_rows lines at most. On a file system that shows what
    is flushed, each answer is safe when put() returns; where a file appears when it is closed, an attempt that dies loses the segment_rows - 1 answers of its last
    file at most. A line that a crash has torn, the last of its file, is dropped; a torn line elsewhere stops the query.
    """

    def __init__(self, folder: str, segment_rows: int = 256):
        self.folder, self.segment_rows = folder, segment_rows

    def writer(self) -> LogWriter:
        return LogWriter(self.folder, self.segment_rows)

    def rows(self, spark: SparkSession) -> DataFrame:
        """All lines, with the file and the place in it; none where there is no log."""
        return read_jsonl_recoverable(spark, f"{self.folder}/*.jsonl", _ROWS)

    def answers(self, spark: SparkSession) -> DataFrame:
        return first_answers(self.rows(spark))

    def clear(self, spark: SparkSession) -> None:
        delete(spark, self.folder)


def first_answers(rows: DataFrame) -> DataFrame:
    """(shard, utterance_id, answer): of several attempts that wrote an answer down, the first counts, by time, file and place; later ones change nothing."""
    order = F.struct("at", "file", "pos")
    return rows.groupBy("shard", "utterance_id").agg(F.min_by("answer", order).alias("answer"))
