"""LM scoring with a log-frequency Bloom filter of quantised n-gram counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import crc_mod, put_file, saved, table
from .textbytes import text_runs

#: Each level of the filter stands for counts some BASE times those of the level below.
BASE = 1.5
LEVELS = 60
#: Bits of the filter for each (n-gram, level), and probes for each. A filter of over MAX_FILTER_BYTES is not sent to executors: n-grams go to its segments.
BITS_PER_ENTRY = 8
PROBES = 5
MAX_FILTER_BYTES = 256 << 20
#: Types with over this share of the training tokens are looked up in a broadcast table: 1 / HEAD_SHARE types at most.
HEAD_SHARE = 1e-6
#: Bytes of text that are counted, and scored, at once; n-grams that are probed at once.
COUNT_BYTES, SCORE_BYTES, PROBE_ROWS = 4 << 20, 4 << 20, 1 << 16
#: Bytes of tokens' levels that are looked at at once.
LEVEL_BYTES = 1 << 20
#: Bytes of text for each segment of the table of counts.
SEGMENT_BYTES = 4 << 20
MIXES = np.array([0.0, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98])

END = np.uint64(xxhash.xxh64_intdigest(b" end of text", 11))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(0x9E3779B97F4A7C15) + (second ^ (second >> np.uint64(29))))


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens, number of tokens by text); each text ends with END."""
    parts, counts, digest, end = [np.zeros(0, np.uint64)], [], xxhash.xxh64_intdigest, [int(END)]
    cuts = offsets.tolist()
    for a, b in zip(cuts, cuts[1:], strict=False):
        own = [digest(w, 11) for w in data[a:b].tobytes().lower().split()]
        parts.append(np.array(own + end, np.uint64))
        counts.append(len(own) + 1)
    return np.concatenate(parts), np.array(counts, np.int64)


def before(tokens: np.ndarray) -> np.ndarray:
    """The token before each; END stands before the first token of a text."""
    return np.concatenate((np.array([END]), tokens[:-1]))


def segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    return ((mixed(hashes) >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def by_segment(hashes: np.ndarray, segments: int, *more: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    seg = segment_of(hashes, segments)
    order = np.argsort(seg, kind="stable")
    cuts = np.searchsorted(seg[order], np.arange(segments + 1))
    for s in range(segments):
        if cuts[s] < cuts[s + 1]:
            yield s, [x[order[cuts[s] : cuts[s + 1]]] for x in (hashes, *more)]


def level_of(counts: np.ndarray) -> np.ndarray:
    """1 for a count of 1; 0 for none."""
    with np.errstate(divide="ignore"):
        level = np.floor(np.log(np.maximum(counts, 1)) / np.log(BASE) + 1e-9).astype(np.int64) + 1
    return np.where(counts > 0, np.minimum(level, LEVELS), 0)


def level_counts() -> np.ndarray:
    """The count that a level stands for: the middle of the whole numbers on it."""
    out = np.zeros(LEVELS + 1)
    for level in range(1, LEVELS + 1):
        low, high = np.ceil(BASE ** (level - 1) - 1e-9), np.ceil(BASE**level - 1e-9) - 1
        out[level] = (low + max(low, high)) / 2
    return out


def places(hashes: np.ndarray, level: int | np.ndarray, bits: np.ndarray | int) -> np.ndarray:
    """PROBES bit places for each hash at a level."""
    one = mixed(hashes ^ (np.asarray(level, np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    two = (one >> np.uint64(33)) | np.uint64(1)
    step = np.arange(PROBES, dtype=np.uint64)[:, None]
    return ((one + step * two) >> np.uint64(3)) % np.asarray(bits, np.uint64)


@dataclass
class CountFilter:
    """Segments of the filter, one after another, and totals of the training tokens. Without bits, the filter is too large to be in one place.

    bits may be the name of a file that each executor has: its Python workers map it and share one copy.
    """

    bits: np.ndarray | str
    starts: np.ndarray
    sizes: np.ndarray
    tokens: int
    types: int
    head: np.ndarray
    head_counts: np.ndarray

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        return level_counts()[self.levels(hashes)]

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """By n-gram: the highest level up to which every probe of every level is set."""
        if isinstance(self.bits, str):
            self.bits = np.asarray(np.memmap(SparkFiles.get(self.bits), np.uint8, "r"))
        parts = [self._levels(hashes[at : at + PROBE_ROWS]) for at in range(0, len(hashes), PROBE_ROWS)]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint8)

    def _levels(self, hashes: np.ndarray) -> np.ndarray:
        seg = segment_of(hashes, len(self.sizes))
        level, open_ = np.zeros(len(hashes), np.int64), np.flatnonzero(self.sizes[seg] > 0)
        for at in range(1, LEVELS + 1):
            if not len(open_):
                break
            own = seg[open_]
            place = places(hashes[open_], at, self.sizes[own])
            byte = self.starts[own][None, :] + (place >> np.uint64(3)).astype(np.int64)
            there = ((self.bits[byte] >> (place & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)
            open_ = open_[there]
            level[open_] = at
        return level.astype(np.uint8)


def _partial_counts(segments: int):
    schema = "seg int, kind int, hashes binary, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_runs(batch.column(0), COUNT_BYTES):
                tokens, _ = token_hashes(data, offsets)
                for kind in (1, 2):
                    keys, n = np.unique(tokens if kind == 1 else pair_hash(before(tokens), tokens), return_counts=True)
                    rows = [(s, kind, h.tobytes(), c.tobytes()) for s, (h, c) in by_segment(keys, segments, n.astype(np.uint32))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                        names=["seg", "kind", "hashes", "counts"],
                    )

    return run, schema


def _summed(hashes: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    h = np.frombuffer(b"".join(hashes), np.uint64)
    c = np.frombuffer(b"".join(counts), np.uint32)
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, int)
    return h[first], np.add.reduceat(c, first) if len(h) else c


_TABLE = "seg int, hashes binary, counts binary, entries long, tokens long, types long, grams binary, levels binary"


def _sum_segment(key: tuple, rows: pa.Table) -> pa.Table:
    """Exact counts of a segment's types, and what its part of the filter will hold."""
    kind = rows.column("kind").to_numpy()
    h, c = rows.column("hashes").to_pylist(), rows.column("counts").to_pylist()
    one = _summed([x for x, k in zip(h, kind, strict=True) if k == 1], [x for x, k in zip(c, kind, strict=True) if k == 1])
    two = _summed([x for x, k in zip(h, kind, strict=True) if k == 2], [x for x, k in zip(c, kind, strict=True) if k == 2])
    grams = np.concatenate((one[0], two[0]))
    levels = level_of(np.concatenate((one[1], two[1])))
    row = {
        "seg": [key[0].as_py()], "hashes": [one[0].tobytes()], "counts": [one[1].tobytes()], "entries": [int(levels.sum())],
        "tokens": [int(one[1].sum())], "types": [len(one[0])], "grams": [grams.tobytes()], "levels": [levels.astype(np.uint8).tobytes()],
    }
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(row.items(), kinds, strict=True)})


def _fill_segment(bits_per_entry: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segs, parts, sizes = batch.column(0).to_pylist(), [], []
            for grams, levels, entries in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                h, q = np.frombuffer(grams, np.uint64), np.frombuffer(levels, np.uint8)
                size = max(64, int(entries * bits_per_entry) // 64 * 64)
                out = np.zeros(size, bool)
                for level in range(1, int(q.max(initial=0)) + 1):
                    own = h[q >= level]
                    for at in range(0, len(own), PROBE_ROWS):
                        out[places(own[at : at + PROBE_ROWS], level, size).astype(np.int64).reshape(-1)] = True
                parts.append(np.packbits(out, bitorder="little").tobytes())
                sizes.append(size)
            yield pa.RecordBatch.from_arrays([pa.array(segs, pa.int32()), pa.array(parts, pa.binary()), pa.array(sizes, pa.int64())], names=["seg", "bits", "size"])

    return run


def _head(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n = np.frombuffer(c, np.int64)
                top = n >= max(least, 1)
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(h, np.uint64)[top].view(np.int64)), pa.array(n[top])], names=["hash", "n"])

    return run


def _with_filter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The exact counts of each segment beside its part of the filter."""
    for batch in batches:
        made = next(_fill_segment(BITS_PER_ENTRY)(iter([batch.select([0, 1, 2, 3])])))
        yield pa.RecordBatch.from_arrays([made.column(0), batch.column(4), batch.column(5), made.column(1), made.column(2)], names=["seg", "hashes", "counts", "bits", "size"])


def build_filter(train: DataFrame, segments: int, text_col: str = "text") -> tuple[DataFrame, CountFilter]:
    """(exact counts of types by segment, the filter). Only the filter, the head and a row of totals a segment come to the driver.

    A filter of over MAX_FILTER_BYTES stays in segments, beside the exact counts, and the CountFilter has totals only.
    """
    run, schema = _partial_counts(segments)
    partial = train.select(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).mapInArrow(run, schema)
    exact = saved(partial.groupBy("seg").applyInArrow(_sum_segment, _TABLE))
    totals = exact.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "types", "entries")]).first()
    if totals["entries"] * BITS_PER_ENTRY > MAX_FILTER_BYTES * 8:
        none = np.zeros(0, np.uint64)
        held = exact.select("seg", "grams", "levels", "entries", "hashes", "counts").mapInArrow(_with_filter, "seg int, hashes binary, counts binary, bits binary, size long")
        return saved(held), CountFilter(none.view(np.uint8), none, none, totals["tokens"], totals["types"], none, none)
    filled = exact.select("seg", "grams", "levels", "entries").mapInArrow(_fill_segment(BITS_PER_ENTRY), "seg int, bits binary, size long").toArrow()
    sizes = np.zeros(segments, np.int64)
    order = np.argsort(filled["seg"].to_numpy())
    sizes[filled["seg"].to_numpy()] = filled["size"].to_numpy()
    lengths = -(-sizes // 8)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    parts = (filled["bits"][int(k)].as_py() for k in order)
    name = put_file(train.sparkSession, [b"\0"] if not len(order) else parts)
    head = exact.select("hashes", "counts").mapInArrow(_head(totals["tokens"] * HEAD_SHARE), "hash long, n long").toArrow()
    keys = head["hash"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    made = CountFilter(name, starts, sizes, totals["tokens"], totals["types"], keys[order], head["n"].to_numpy()[order])
    return exact.select("seg", "hashes", "counts"), made


def gram_levels(tokens: np.ndarray, grams: CountFilter) -> np.ndarray:
    """By token: the filter's levels of the token, and of it with the one before. A run's n-grams are probed once each."""
    types, at = np.unique(tokens, return_inverse=True)
    own = grams.levels(types)[at]
    pairs, at = np.unique(pair_hash(before(tokens), tokens), return_inverse=True)
    return np.stack((own, grams.levels(pairs)[at]), axis=1)


def by_text(levels: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The levels of each text's tokens, two bytes a token."""
    offsets = np.concatenate(([0], 2 * np.cumsum(counts))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(levels))])


def gram_counts(levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By token of whole texts: the counts of the token, of the one before and of both. levels has two bytes a token."""
    own, pair = level_counts()[levels.reshape(-1, 2)].T
    first = np.concatenate((own[-1:], own[:-1]))  # each text ends with END, which also stands before the next
    both = np.minimum(pair, own)  # a pair is never more frequent than its words
    return own, np.maximum(first, both), both


def chance(own: np.ndarray, first: np.ndarray, both: np.ndarray, grams: CountFilter, mix: np.ndarray) -> np.ndarray:
    """Mixed probability; mix gives the weight of the pair by the level of the count of the word before."""
    single = (own + 0.5) / (grams.tokens + 0.5 * (grams.types + 1))
    weight = np.where(first > 0, mix[level_of(first)], 0.0)
    return np.minimum(weight * both / np.maximum(first, 1) + (1 - weight) * single, 1.0)


def _gains(own: np.ndarray, first: np.ndarray, both: np.ndarray, grams: CountFilter) -> np.ndarray:
    """By level and weight: the log probability of tokens, each left out of its own counts."""
    own, first, both = (np.maximum(x - 1, 0) for x in (own, first, both))
    single = (own + 0.5) / (grams.tokens + 0.5 * (grams.types + 1))
    pair = np.minimum(both, first) / np.maximum(first, 1)
    level = level_of(first + 1)
    return np.stack([np.bincount(level, np.log(m * pair + (1 - m) * single), LEVELS + 1) for m in MIXES], axis=1)


def fit_mix(levels: DataFrame, grams: CountFilter) -> np.ndarray:
    """levels: a column of the levels of all training documents' tokens. By level, the weight that suits them best, each token left out of its own counts.

    What comes back from a task is a number for each level and weight.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.zeros((LEVELS + 1, len(MIXES)))
        for batch in batches:
            for _, _, data, _ in text_runs(batch.column(0), LEVEL_BYTES):
                if len(data):
                    gain += _gains(*gram_counts(data), grams)
        at = [np.repeat(np.arange(LEVELS + 1), len(MIXES)), np.tile(np.arange(len(MIXES)), LEVELS + 1)]
        yield pa.RecordBatch.from_pydict({"level": pa.array(at[0]), "mix": pa.array(at[1]), "gain": pa.array(gain.reshape(-1))})

    got = levels.mapInArrow(run, "level long, mix long, gain double").groupBy("level", "mix").agg(F.sum("gain").alias("gain")).toPandas()
    gain = np.zeros((LEVELS + 1, len(MIXES)))
    gain[got["level"], got["mix"]] = got["gain"]
    return MIXES[gain.argmax(axis=1)]


def _scores(grams: CountFilter, mix: np.ndarray):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for levels in batches:
            parts = [np.zeros(0)]
            for i, j, data, offsets in text_runs(levels, LEVEL_BYTES):
                doc = np.repeat(np.arange(j - i), np.diff(offsets) // 2)
                parts.append(np.bincount(doc, np.log10(chance(*gram_counts(data), grams, mix)), j - i))
            yield pa.array(np.concatenate(parts))

    return F.arrow_udf(run, "double")


def packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


_ASK = "run string, seg int, hashes binary, docs binary, meta binary"
_ASK_TYPES = (pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary())


def _score_runs(grams, segments: int):
    """A row for each run of texts with what is known of each, and rows that ask segments for exact counts of rarer tokens."""
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: CountFilter = grams.value
        part, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            for i, j, data, offsets in text_runs(batch.column(0), SCORE_BYTES):
                name, nth = f"{part}-{nth}", nth + 1
                tokens, counts = token_hashes(data, offsets)
                doc = np.repeat(np.arange(j - i, dtype=np.uint32), counts)
                levels = by_text(gram_levels(tokens, model), counts)
                at = np.minimum(np.searchsorted(model.head, tokens), max(len(model.head) - 1, 0))
                known = model.head[at] == tokens if len(model.head) else np.zeros(len(tokens), bool)
                base = np.bincount(doc[known], np.log10(model.head_counts[at[known]] + 0.5), j - i) if known.any() else np.zeros(j - i)
                ids = batch.column(1).slice(i, j - i)
                meta = pa.RecordBatch.from_arrays(
                    [ids, batch.column(2).slice(i, j - i), pa.array(counts), pa.array(np.bincount(doc[known], minlength=j - i)), pa.array(base), levels],
                    names=["id", "held", "n", "known", "base", "levels"],
                )
                rows = [(name, (part * 31 + nth) % segments, None, None, packed(meta))]
                rest = ~known
                rows += [(name, s, h.tobytes(), d.tobytes(), None) for s, (h, d) in by_segment(tokens[rest], segments, doc[rest])]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_ASK_TYPES)], names=[f.split()[0] for f in _ASK.split(", ")])

    return run


_TELL = "run string, docs binary, known binary, base binary, meta binary"


def _answer(key: tuple, asked: pa.Table, counted: pa.Table) -> pa.Table:
    """Looks the tokens of a segment up in its exact counts and adds up by document."""
    keys = np.frombuffer(counted["hashes"][0].as_py(), np.uint64) if counted.num_rows else np.zeros(0, np.uint64)
    count = np.frombuffer(counted["counts"][0].as_py(), np.int64) if counted.num_rows else np.zeros(0, np.int64)
    rows: list[tuple] = []
    for name, h, d, meta in zip(*(asked[c].to_pylist() for c in ("run", "hashes", "docs", "meta")), strict=True):
        if meta is not None:
            rows.append((name, None, None, None, meta))
            continue
        h, d = np.frombuffer(h, np.uint64), np.frombuffer(d, np.uint32)
        at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
        found = np.where(keys[at] == h, count[at], 0) if len(keys) else np.zeros(len(h), np.int64)
        docs, own = np.unique(d, return_inverse=True)
        known, base = np.bincount(own, found > 0, len(docs)), np.bincount(own, np.log10(found + 0.5), len(docs))
        rows.append((name, docs.astype(np.uint32).tobytes(), known.astype(np.uint32).tobytes(), base.tobytes(), None))
    return pa.table({f.split()[0]: pa.array([r[k] for r in rows], t) for k, (f, t) in enumerate(zip(_TELL.split(", "), (pa.string(), *[pa.binary()] * 4), strict=True))})


def _put_together(key: tuple, rows: pa.Table) -> pa.Table:
    meta = next(pa.ipc.open_stream(m).read_all() for m in rows["meta"].to_pylist() if m is not None).combine_chunks()
    known, base = meta["known"].to_numpy().astype(np.int64), meta["base"].to_numpy().copy()
    for d, k, b in zip(*(rows[c].to_pylist() for c in ("docs", "known", "base")), strict=True):
        if d is not None:
            at = np.frombuffer(d, np.uint32)
            known[at] += np.frombuffer(k, np.uint32)
            base[at] += np.frombuffer(b, np.float64)
    return pa.table({"id": meta["id"], "held": meta["held"], "n": meta["n"], "known": pa.array(known), "base": pa.array(base), "levels": meta["levels"]})


_ASK_GRAMS = "run string, seg int, kind int, hashes binary, places binary, meta binary, tokens binary"
_ASK_GRAMS_TYPES = (pa.string(), pa.int32(), pa.int32(), *[pa.binary()] * 4)
_TELL_GRAMS = "run string, kind int, places binary, counts binary, exact binary, meta binary, tokens binary"
_TELL_GRAMS_TYPES = (pa.string(), pa.int32(), *[pa.binary()] * 5)


def _ask_segments(segments: int):
    """A row for each run of texts with its tokens, as numbers of its types (kind 1) and pairs (kind 2), and rows that ask segments for those n-grams."""
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            for i, j, data, offsets in text_runs(batch.column(0), SCORE_BYTES):
                name, nth = f"{part}-{nth}", nth + 1
                tokens, n = token_hashes(data, offsets)
                types, one = np.unique(tokens, return_inverse=True)
                pairs, two = np.unique(pair_hash(before(tokens), tokens), return_inverse=True)
                meta = pa.RecordBatch.from_arrays([batch.column(1).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(n)], names=["id", "held", "n"])
                rows = [(name, (part * 31 + nth) % segments, 0, None, None, packed(meta), np.stack((one, two)).astype(np.uint32).tobytes())]
                for kind, own in ((1, types), (2, pairs)):
                    rows += [(name, s, kind, h.tobytes(), at.tobytes(), None, None) for s, (h, at) in by_segment(own, segments, np.arange(len(own), dtype=np.uint32))]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_ASK_GRAMS_TYPES)], names=[f.split()[0] for f in _ASK_GRAMS.split(", ")])

    return run


def _answer_grams(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
    """Probes a segment's part of the filter, and looks its types up in the exact counts."""
    made = None
    if held.num_rows:
        bits, size, none = np.frombuffer(held["bits"][0].as_py(), np.uint8), held["size"][0].as_py(), np.zeros(0, np.uint64)
        made = CountFilter(bits, np.array([0]), np.array([size]), 0, 0, none, none)
        keys, n = np.frombuffer(held["hashes"][0].as_py(), np.uint64), np.frombuffer(held["counts"][0].as_py(), np.int64)
    rows: list[tuple] = []
    for name, kind, h, places_, meta, tokens in zip(*(asked[c].to_pylist() for c in ("run", "kind", "hashes", "places", "meta", "tokens")), strict=True):
        if kind == 0:
            rows.append((name, 0, None, None, None, meta, tokens))
            continue
        h, exact = np.frombuffer(h, np.uint64), None
        levels = made.levels(h) if made else np.zeros(len(h), np.uint8)
        if kind == 1:
            exact = np.zeros(len(h), np.int64)
            if made and len(keys):
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                exact = np.where(keys[at] == h, n[at], 0)
            exact = exact.tobytes()
        rows.append((name, kind, places_, levels.tobytes(), exact, None, None))
    return pa.table({f.split()[0]: pa.array([r[k] for r in rows], t) for k, (f, t) in enumerate(zip(_TELL_GRAMS.split(", "), _TELL_GRAMS_TYPES, strict=True))})


def _told(asked: DataFrame, exact: DataFrame) -> DataFrame:
    return asked.groupBy("seg").cogroup(exact.groupBy("seg")).applyInArrow(_answer_grams, _TELL_GRAMS)


def _run_counts(rows: pa.Table) -> tuple:
    """(what is known of the run's texts, exact counts by token, and what gram_levels gives) from the answers of segments."""
    found = list(zip(*(rows[c].to_pylist() for c in ("kind", "places", "counts", "exact", "meta", "tokens")), strict=True))
    meta, at = next((m, np.frombuffer(t, np.uint32).reshape(2, -1)) for k, *_, m, t in found if k == 0)
    level, exact = [np.zeros(int(x.max()) + 1, np.uint8) for x in at], np.zeros(int(at[0].max()) + 1, np.int64)
    for kind, own, counts, n, _, _ in found:
        if kind:
            own = np.frombuffer(own, np.uint32)
            level[kind - 1][own] = np.frombuffer(counts, np.uint8)
            if kind == 1:
                exact[own] = np.frombuffer(n, np.int64)
    levels = np.stack([x[k] for x, k in zip(level, at, strict=True)], axis=1)
    return pa.ipc.open_stream(meta).read_all().combine_chunks(), exact[at[0]], levels


def _put_told(key: tuple, rows: pa.Table) -> pa.Table:
    meta, exact, levels = _run_counts(rows)
    n = meta["n"].to_numpy()
    doc = np.repeat(np.arange(len(n)), n)
    known, base = np.bincount(doc, exact > 0, len(n)).astype(np.int64), np.bincount(doc, np.log10(exact + 0.5), len(n))
    return pa.table({"id": meta["id"], "held": meta["held"], "n": meta["n"], "known": pa.array(known), "base": pa.array(base), "levels": by_text(levels, n)})


def score_documents(
    docs: DataFrame, train: str | None = None, id_col: str = "doc_id", text_col: str = "text", held_out_col: str = "_held"
) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    docs has a boolean column held_out_col; the other rows are learned from. Words and pairs of
    words are counted exactly, by hash segments that grow in number with the input, and each
    segment writes its own part of the log-frequency filter: an n-gram of count c is entered for
    levels 1 to 1 + log(c), and a count is read back by probing level after level. The filter holds
    all n-grams at BITS_PER_ENTRY bits for each (n-gram, level). Up to MAX_FILTER_BYTES each executor gets one copy, which its workers share;
    a larger one stays in its segments, and the n-grams of each run of texts are sent there and their
    counts come back, with the same scores. score is the log10 probability under
    a mixture of pair and word, whose weights are fitted by leaving one out. base_score needs exact
    counts of all types, which no broadcast may hold: frequent types (1 / HEAD_SHARE at most) are
    broadcast, tokens of the others go to their segment by a shuffle and their sums come back.

    A null text is the empty text and has its end token alone. A null held-out mark counts as
    learned from. Rows that repeat give a row each. Without learned rows all tokens are unknown.
    Other columns of the input are not read. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(text.alias("_text"), F.col(id_col).alias("_id"), F.coalesce(F.col(held_out_col), F.lit(False)).alias("_held"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    segments = max(12, -(-size // SEGMENT_BYTES))
    learned = rows.filter(~F.col("_held"))
    exact, grams = build_filter(learned, segments, "_text")
    shared = docs.sparkSession.sparkContext.broadcast(grams)
    kind = rows.schema["_id"].dataType.simpleString()
    scored = f"id {kind}, held boolean, n long, known long, base double, levels binary"
    if len(grams.sizes):
        asked = rows.mapInArrow(_score_runs(shared, segments), _ASK)
        told = asked.groupBy("seg").cogroup(exact.groupBy("seg")).applyInArrow(_answer, _TELL)
        whole = told.groupBy("run").applyInArrow(_put_together, scored)
    else:
        asked = rows.mapInArrow(_ask_segments(segments), _ASK_GRAMS)
        whole = _told(asked, exact).groupBy("run").applyInArrow(_put_told, scored)
    whole = saved(whole, "zstd")  # the n-grams are probed once; the levels fit the mixture and give the scores
    totals = replace(grams, bits=np.zeros(0, np.uint8), head=grams.head[:0], head_counts=grams.head_counts[:0])
    mix = fit_mix(whole.filter("not held").select("levels"), totals)
    norm = float(np.log10(grams.tokens + 0.5 * (grams.types + 1)))
    return whole.select(
        F.col("id").alias(id_col), F.col("held").alias("held_out"), F.col("n").alias("n_tokens"), F.col("known").alias("n_known"),
        F.lit(grams.tokens).cast("long").alias("train_tokens"), (F.col("base") - F.col("n") * norm).alias("base_score"),
        _scores(totals, mix)("levels").alias("score"),
    )


def op1_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs.withColumn("_held", crc_mod("doc_id", 5) == 1))
