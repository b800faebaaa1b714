"""Packing of tokenised documents into sequences of a fixed length: best-two-fit over the counts of lengths."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import saved, table
from .textbytes import text_runs

CAPACITY, END = 1024, 2
VOCABULARY = "byte_bpe_50k.json"
#: Texts that a task encodes at once, in bytes; a longer text is encoded by itself.
RUN_BYTES = 1 << 23
#: Distinct words that a task keeps with their ids; beyond it starts again from none.
KEPT_WORDS = 1 << 20
#: Pieces that are numbered together, where MAX_SLICES allows it; the table of offsets has MAX_SLICES rows and one for each length at most.
SLICE_ROWS, MAX_SLICES = 4096, 1_000_000

# A byte-level BPE begins a new word, whatever else stands there, before a space that one of _WORD follows, and after one of _ALNUM before any other byte
# of ASCII but the apostrophe of contractions. Bytes that may begin white space beyond ASCII (C2, E1, E2, E3) are not in _WORD.
_WORD, _ALNUM, _OTHER = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_WORD[0x21:0x7F] = _WORD[0xC3:0xF5] = _OTHER[0x09:0x7F] = True
_WORD[[0xE1, 0xE2, 0xE3]] = False
for _first, _after in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    _ALNUM[_first:_after], _OTHER[_first:_after] = True, False
_OTHER[[0x20, 0x27]] = False


class WordEncoder:
    """Ids of many texts at once: texts are cut into words where the tokenizer would, and each distinct word is encoded once."""

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end
        self.tokenizer.encode_special_tokens = True  # the names of special tokens in a text are text
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.lengths, self.fresh = np.array([self.end], np.uint32), np.array([1]), []

    def _codes(self, words: pa.Array) -> np.ndarray:
        """Places of distinct words among the known ones; the first place is the end mark."""
        texts = words.to_pylist()
        if len(self.known) + len(texts) > KEPT_WORDS:
            self._forget()
        new = [w for w in texts if w not in self.known]
        if new:
            self.known.update(zip(new, range(len(self.known) + 1, len(self.known) + 1 + len(new)), strict=True))
            got = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)]
            self.lengths = np.concatenate([self.lengths, np.fromiter(map(len, got), np.int64, len(got))])
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(got), np.uint32)])
        return np.fromiter((self.known[w] for w in texts), np.int64, len(texts))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end mark, laid end to end; number of ids of each text)."""
        texts = len(offsets) - 1
        cut = np.zeros(len(data) + 1, bool)
        if len(data):
            cut[:-2] = (data[:-1] == 0x20) & _WORD[data[1:]]
            cut[1:-1] |= _ALNUM[data[:-1]] & _OTHER[data[1:]]
        cut[offsets] = True
        at = np.nonzero(cut)[0]
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = words.dictionary_encode()
        codes = self._codes(coded.dictionary)[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
        codes = np.insert(codes, np.searchsorted(at, offsets[1:]), 0)
        lengths = self.lengths[codes]
        starts, ends = np.cumsum(self.lengths) - self.lengths, np.cumsum(lengths)
        ids = self.ids[np.repeat(starts[codes] - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]
        done = ends[np.nonzero(codes == 0)[0]]
        assert len(done) == texts
        return ids, np.diff(done, prepend=0)


def cut_pieces(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, start, length) of all pieces: whole ones of capacity, before them the rest, if there is one."""
    n = -(-lengths // capacity)
    doc = np.repeat(np.arange(len(lengths)), n)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    first = (lengths - (n - 1) * capacity)[doc]
    start = np.where(piece == 0, 0, first + (piece - 1) * capacity)
    return doc, piece, start, np.where(piece == 0, first, capacity)


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids (unsigned 32-bit, little-endian).

    A text's ids, by the file of a tokenizer at path (byte-level BPE without a normal form), and the end mark; what is longer than capacity is cut into pieces, of
    which only the first may be shorter. A null text is the empty text: one piece with the end mark. Words are cut where the tokenizer itself begins a new one,
    and distinct words are encoded once a task. Rows that repeat give pieces of their own. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path, end)
        for batch in batches:
            for i, _, data, offsets in text_runs(batch.column(1), RUN_BYTES):
                ids, lengths = encoder.encode(data, offsets)
                doc, piece, start, size = cut_pieces(lengths, capacity)
                cuts = np.concatenate(([0], np.cumsum(size))) * 4
                laid = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])
                for at in range(0, len(size), 8192):
                    some = slice(at, at + 8192)
                    cols = [batch.column(0).take(pa.array(doc[some] + i)), pa.array(piece[some], pa.int32()), pa.array(start[some]), pa.array(size[some]), laid[some].cast(pa.binary())]
                    yield pa.RecordBatch.from_arrays(cols, names=["id", "piece", "start", "length", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids binary").withColumnRenamed("id", id_col)


def best_pair(left: np.ndarray, room: int, floor: int) -> tuple[int, int] | None:
    """Two lengths, both left, that fill room the most and more than floor; of equals the pair with the longest piece."""
    have = np.nonzero(left[: room + 1])[0]
    if not len(have):
        return None
    upto = np.zeros(room + 1, np.int64)  # the longest piece left that is not longer than a length; 0 for none
    upto[have] = have
    upto = np.maximum.accumulate(upto)
    mate = upto[room - have]
    # a length that is left once only cannot be its own mate: then the next shorter one is
    alone = (mate == have) & (left[have] < 2)
    mate = np.where(alone, upto[np.maximum(np.minimum(room - have, have - 1), 0)], mate)
    total = np.where(mate > 0, have + mate, 0)
    k = len(total) - 1 - int(np.argmax(total[::-1]))
    return (int(have[k]), int(mate[k])) if total[k] > floor else None


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(bins, {length: pieces in each}) until all pieces have a bin.

    A bin takes the longest piece that fits until none does. If a gap is left, its smallest piece gives way to the two pieces, of those not packed, that
    fill the gap and its place the most, if they leave less of it. Pieces of one length are alike, so a content is used for as many bins as the counts
    of its lengths allow: a length that falls short halves at least each time, which bounds the contents by capacity * log2(capacity), whatever
    the number of pieces.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out = []
    while True:
        have, room, content = np.nonzero(left)[0], capacity, {}
        if not len(have):
            return out
        at = len(have)
        while True:
            at = int(np.searchsorted(have[:at], room, side="right")) - 1
            if at < 0:
                break
            length = int(have[at])
            content[length] = min(int(left[length]), room // length)
            room -= content[length] * length
        if room and len(content) + next(iter(content.values())) > 2:
            small = min(content)
            for length, n in content.items():
                left[length] -= n
            pair = best_pair(left, room + small, small)
            for length, n in content.items():
                left[length] += n
            if pair:
                content[small] -= 1
                for length in pair:
                    content[length] = content.get(length, 0) + 1
                content = {length: n for length, n in content.items() if n}
        times = min(int(left[length]) // n for length, n in content.items())
        for length, n in content.items():
            left[length] -= times * n
        out.append((times, content))


def bin_places(plan: list[tuple[int, dict[int, int]]]) -> tuple[np.ndarray, ...]:
    """The plan by pieces: columns length, first (number, among pieces of the length, of the first that is meant), bin, each (pieces a bin), offset; sorted."""
    rows, used, first_bin = [], {}, 0
    for times, content in plan:
        offset = 0
        for length, n in sorted(content.items(), reverse=True):
            rows.append((length, used.get(length, 0), first_bin, n, offset))
            used[length] = used.get(length, 0) + times * n
            offset += n * length
        first_bin += times
    return tuple(np.array(sorted(rows), np.int64).reshape(-1, 5).T)


def _places(shared, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, bins, each, offset = shared.value
        starts = np.searchsorted(length, np.arange(capacity + 2))
        for batch in batches:
            size, nth = batch.column("_length").to_numpy(), batch.column("_nth").to_numpy()
            at = np.empty(len(size), np.int64)
            for one in np.unique(size):
                mine, own = size == one, slice(starts[one], starts[one + 1])
                at[mine] = starts[one] + np.searchsorted(first[own], nth[mine], side="right") - 1
            step = nth - first[at]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_piece"), pa.array(bins[at] + step // each[at]), pa.array(offset[at] + step % each[at] * size)], names=["_piece", "_bin", "_offset"]
            )

    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece"), length_col: str = "length") -> DataFrame:
    """The pieces with sequence_id and offset: sequences of at most capacity, gapless from offset 0.

    What goes to the driver is how many pieces of each length there are, capacity numbers at most; the plan made of them (plan_bins) is as bounded, and
    broadcast. Pieces of a length are numbered in slices of a hash of the columns in order, each slice on its own and moved by the pieces of the slices before it, so
    that a length that a third of all pieces have is many slices, in number as its count; rows that agree in order share a slice. Numbers follow (slice, order); the
    number tells the bin. A length must be from 1 to capacity. Columns of other names are kept as they are; an empty table gives an empty result.
    """
    spark = pieces.sparkSession
    told = pieces.select(F.struct("*").alias("_piece"), F.col(length_col).cast("long").alias("_length"), F.xxhash64(*[F.col(c) for c in order]).alias("_hash"))
    counts = {r["_length"]: r["n"] for r in told.groupBy("_length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(c is None or not 1 <= c <= capacity for c in counts):
        raise ValueError(f"a piece's length must be from 1 to {capacity}")
    rows_a_slice = max(SLICE_ROWS, -(-sum(counts.values()) // MAX_SLICES))
    slices = F.broadcast(spark.createDataFrame([(c, -(-n // rows_a_slice)) for c, n in counts.items()], "_length long, _slices long"))
    sliced = told.join(slices, "_length").withColumn("_slice", F.pmod("_hash", "_slices")).drop("_slices", "_hash")
    upto = Window.partitionBy("_length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy("_length", "_slice").agg(F.count(F.lit(1)).alias("_n")).select("_length", "_slice", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    own = Window.partitionBy("_length", "_slice").orderBy(*[F.col(f"_piece.{c}") for c in order])
    numbered = sliced.withColumn("_own", F.row_number().over(own)).join(F.broadcast(offsets), ["_length", "_slice"])
    shared = spark.sparkContext.broadcast(bin_places(plan_bins(counts, capacity)))
    asked = numbered.select("_piece", "_length", (F.col("_before") + F.col("_own") - 1).alias("_nth"))
    kind = asked.schema["_piece"].dataType.simpleString()
    placed = asked.mapInArrow(_places(shared, capacity), f"_piece {kind}, _bin long, _offset long")
    return placed.select("_piece.*", F.col("_bin").alias("sequence_id"), F.col("_offset").alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids: the ids of a sequence's pieces laid end to end. A sequence holds the plan's capacity at most."""
    laid = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(laid, F.lit(b"").cast("binary"), lambda all_, p: F.concat(all_, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op12_packing(spark, sf_dir: str) -> DataFrame:
    """Pieces of documents with the checksum of their ids in place of the ids."""
    pieces = token_pieces(table(spark, sf_dir, "documents"), vocabulary_path())
    short = saved(pieces.withColumn("ids_crc32", F.crc32("ids").cast("long")).drop("ids"))
    return pack_pieces(short)
