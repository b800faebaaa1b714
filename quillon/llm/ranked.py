"""Ranked lexical search: an index of dual-sorted wavelet trees, one a shard of documents, and exact top-k by best-first search."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from heapq import heappop, heappush, heappushpop
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import UPPER, lower_ascii, saved, table, text_or_empty
from .textbytes import each_text, spans

#: Fixed value: what a term is made of, as a Java or RE2 pattern.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 50
#: Bytes of text in a shard (a longer text is a shard of its own), and terms of queries that go through the index together.
SHARD_BYTES, BLOCK_TERMS = 1 << 22, 1_000_000
#: Nodes of a tree that are opened together.
STEP = 64
#: An Arrow batch to a Python worker takes no further row from so many bytes on, and a row group of the saved index none either: so tasks hold a shard or two, however many there are.
BATCH_BYTES = 1 << 20
_ROW_GROUPS = {
    "parquet.block.size": str(BATCH_BYTES), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.enable.dictionary": "false",
}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0
_LOWER[0x41:0x5B] = np.frombuffer(UPPER.lower().encode(), np.uint8)
_MASK = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


def term_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, 0 where they are in no term; starts and ends of the terms)."""
    low = _LOWER[data]
    inside = np.zeros(len(low) + 2, bool)
    inside[1:-1] = low != 0
    edge = inside[1:] != inside[:-1]
    at = np.nonzero(edge)[0]
    return low, at[::2], at[1::2]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(the texts with a zero byte between them, where each starts)."""
    return np.frombuffer(b"\0".join(texts), np.uint8), np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]


def _text_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = terms = 0
    for batch in batches:
        for text in each_text(batch.column(0)):
            n = len(term_places(np.frombuffer(text, np.uint8))[1])
            docs, terms = docs + (n > 0), terms + n
    yield pa.RecordBatch.from_arrays([pa.array([docs]), pa.array([terms])], names=["docs", "terms"])


def corpus_size(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(documents with a term, all their terms with repeats)."""
    told = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(_text_counts, "docs long, terms long")
    return tuple(told.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("docs", "terms")]).first())


def impacts_of(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """A posting's share of a score before the term's weight: terms counted tf times in documents of n terms."""
    m = 50 + 50 * n * docs // max(terms, 1)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def term_weight(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


_TREE = ("starts", "bits", "zeros", "bounds", "scale", "impacts")
#: The columns of a saved shard beside its number and its ids, each packed.
_SHARD = ("ends", "letters", *_TREE)


def packed(data) -> bytes:
    """Compressed by the task itself, so that the JVM handles small values only; begins with the size."""
    return memoryview(data).nbytes.to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(data, asbytes=True)


def unpacked(value: pa.Scalar) -> bytes:
    whole = value.as_buffer()
    size = int.from_bytes(whole[:8].to_pybytes(), "little")
    return pa.Codec("zstd").decompress(whole[8:], size, asbytes=True) if size else b""


def packed_terms(terms: pa.StringArray) -> tuple[bytes, bytes]:
    """(where each term ends, their bytes)."""
    data, at = spans(terms)
    return packed(at[1:].astype(np.int32).tobytes()), packed(data.tobytes())


def unpacked_terms(ends: pa.Scalar, letters: pa.Scalar) -> pa.StringArray:
    at = np.concatenate((np.zeros(1, np.int32), np.frombuffer(unpacked(ends), np.int32)))
    return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(unpacked(letters)))


@contextmanager
def small_batches(spark: SparkSession, at_most: int = BATCH_BYTES):
    """Within it, this session's queries send Arrow batches that end from so many bytes on."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(at_most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def build_tree(texts: list[bytes], docs: int, terms: int) -> dict:
    """The index of a shard whose documents are numbered as the texts stand.

    All postings lie in one sequence, term after term, those of a term by falling impact: that is the root. Level by level they are parted, in order, by a bit of the
    document's number, from the highest: the bits are the wavelet tree. In each node a term's postings stay together and by impact, so the first of them
    bounds the node's documents. For that each level keeps the impacts on a scale of 256 steps, rounded up, and the last level keeps them as they are.
    """
    data, at = joined(texts)
    low, start, end = term_places(data)
    doc = (np.searchsorted(at, start, side="right") - 1).astype(np.int32)
    cuts = np.concatenate(([0], np.cumsum(end - start)))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(low[low != 0])]).dictionary_encode()
    own, sizes = words.dictionary, np.bincount(doc, minlength=len(texts))
    key = words.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(texts) + doc
    del data, low, start, end, doc, cuts, words
    key.sort()
    first = np.nonzero(np.concatenate(([True], key[1:] != key[:-1])))[0] if len(key) else np.zeros(0, np.int64)
    tf = np.diff(first, append=len(key))
    term, seq = key[first] // len(texts), (key[first] % len(texts)).astype(np.int32)
    impact = impacts_of(tf, sizes[seq], docs, terms)
    del key, first, tf
    order = np.argsort((term << 20) - impact, kind="stable")  # an impact is under 2**20
    seq, impact = seq[order], impact[order].astype(np.int32)
    height, n = max(1, (len(texts) - 1).bit_length()), len(seq)
    low_, high = (int(impact.min()), int(impact.max())) if n else (1, 1)
    scale = np.unique(np.ceil(np.geomspace(max(low_, 1), max(high, 1), 256)).astype(np.int64))
    scale[-1] = max(high, 1)
    level = np.searchsorted(scale, impact).astype(np.uint8)
    bits, zeros, bounds = np.zeros((height, n // 64 + 1, 8), np.uint8), np.zeros(height, np.int64), np.zeros((height - 1, n), np.uint8)
    for k in range(height):
        one = (seq >> (height - 1 - k) & 1).astype(bool)
        laid = np.packbits(one, bitorder="little")
        bits[k].reshape(-1)[: len(laid)] = laid
        zeros[k] = n - np.count_nonzero(one)
        part = lambda x, one=one: np.concatenate((x[~one], x[one]))
        seq, impact, level = part(seq), part(impact), part(level)
        if k < height - 1:
            bounds[k] = level
    return {
        "terms": own.cast(pa.large_string()).cast(pa.string()), "starts": np.searchsorted(term, np.arange(len(own) + 1)).astype(np.int64).tobytes(), "bits": bits.tobytes(),
        "zeros": zeros.tobytes(), "bounds": bounds.tobytes(), "scale": scale.tobytes(), "impacts": impact.tobytes(),
    }


class WaveletTree:
    """A shard's index, read from its columns."""

    def __init__(self, docs: int, starts: bytes, bits: bytes, zeros: bytes, bounds: bytes, scale: bytes, impacts: bytes):
        self.docs, self.starts, self.zeros = docs, np.frombuffer(starts, np.int64), np.frombuffer(zeros, np.int64)
        self.words, self.height = np.frombuffer(bits, np.uint64), len(self.zeros)
        self.width = len(self.words) // self.height
        ones = np.bitwise_count(self.words).astype(np.int64).reshape(self.height, self.width)
        self.before = (np.cumsum(ones, axis=1) - ones).astype(np.int32).reshape(-1)
        self.bounds, self.scale, self.impacts = np.frombuffer(bounds, np.uint8), np.frombuffer(scale, np.int64), np.frombuffer(impacts, np.int32)

    def ones(self, level: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many 1 bits a level has before a place."""
        word = level * self.width + (at >> 6)
        return self.before[word] + np.bitwise_count(self.words[word] & _MASK[at & 63])

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, document) of the k best, equal scores by document; all if fewer score above 0.

        Nodes are opened by falling bound, STEP at once; what is left when no bound reaches the k-th score cannot be among the best. Of nodes with its very bound
        only those that begin before its document can.
        """
        n, best, heap = len(self.impacts), [], [(0, 0, 0, 0)]
        pool = np.empty((2, 256, len(terms)), np.int64)
        pool[0, 0], pool[1, 0] = self.starts[terms], self.starts[terms + 1]
        used, full = 1, False
        if not n or not len(terms):
            return []
        while heap:
            taken = []
            while heap and len(taken) < STEP:
                node = heappop(heap)
                if full and node[2] and (-node[0] < best[0][0] or (-node[0] == best[0][0] and node[1] > -best[0][1])):
                    heap = []
                    break
                taken.append(node)
            if not taken:
                break
            _, lo, level, row = np.array(taken, np.int64).T
            span = pool[:, row]
            right = self.ones(level[:, None], span)
            zero = self.zeros[level][:, None]
            child = np.concatenate((span - right, right + zero), axis=1)
            lows = np.concatenate((lo, lo + (1 << (self.height - 1 - level))))
            depth = np.concatenate((level, level)) + 1
            has = child[1] > child[0]
            at = np.where(has, child[0], 0)
            leaf = depth == self.height
            worth = np.empty(at.shape, np.int64)
            worth[leaf] = self.impacts[at[leaf]]
            worth[~leaf] = self.scale[self.bounds[(depth[~leaf, None] - 1) * n + at[~leaf]]]
            score = np.where(has, worth, 0) @ weights
            alive = np.nonzero(score > 0)[0]
            if full:
                alive = alive[score[alive] >= best[0][0]]
            inner = alive[~leaf[alive]]
            for s, d in zip(score[alive[leaf[alive]]].tolist(), lows[alive[leaf[alive]]].tolist(), strict=True):
                if full:
                    heappushpop(best, (s, -d))
                else:
                    heappush(best, (s, -d))
                    full = len(best) == k
            if used + len(inner) > pool.shape[1]:
                pool = np.concatenate((pool, np.empty((2, max(pool.shape[1], len(inner)), len(terms)), np.int64)), axis=1)
            pool[:, used : used + len(inner)] = child[:, inner]
            for s, d, h, r in zip(score[inner].tolist(), lows[inner].tolist(), depth[inner].tolist(), range(used, used + len(inner)), strict=True):
                heappush(heap, (-s, d, h, r))
            used += len(inner)
        return [(s, -d) for s, d in sorted(best, reverse=True)]


def _index(docs: int, terms: int, shard_bytes: int):
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

        def shard():
            all_ids = pa.concat_arrays(ids)
            order = pc.array_sort_indices(all_ids, null_placement="at_end")
            made = build_tree([texts[i] for i in order.to_pylist()], docs, terms)
            cols = [pa.array([(part << 32) + nth]), pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), all_ids.take(order))]
            for one in (*packed_terms(made["terms"]), *(packed(made[c]) for c in _TREE)):
                cols.append(pa.array([one], pa.binary()))
            return pa.RecordBatch.from_arrays(cols, names=["shard", "ids", *_SHARD])

        for batch in batches:
            first = 0
            for i, text in enumerate(each_text(batch.column(1)), 1):
                texts.append(text)
                size += len(text)
                if size >= shard_bytes or i == batch.num_rows:
                    ids.append(batch.column(0).slice(first, i - first))
                    first = i
                if size >= shard_bytes:
                    yield shard()
                    nth, ids, texts, size = nth + 1, [], [], 0
        if texts:
            yield shard()

    return run


@dataclass(frozen=True)
class RankedIndex:
    """shards: one row a shard, saved; docs and terms: what impacts were made with."""

    shards: DataFrame
    docs: int
    terms: int


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> RankedIndex:
    """An index of all terms of all documents, in the shared folder.

    Terms are the maximal matches of TERM, A-Z lower-cased, in the whole text; a null text has none. Texts are read twice, once for the size of the corpus, which every
    impact needs, and once by the tasks that make a tree of each shard_bytes of text; no text is shuffled, and a task holds one shard at a time. Within a shard
    documents are numbered by id, null ids last; rows that repeat are documents of their own. An empty table gives an index without shards. A shard is packed by its
    task, and row groups and batches end with the shard that fills them, so no step's memory follows the number of shards.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"shard long, ids array<{kind}>, " + ", ".join(f"{c} binary" for c in _SHARD)
    with small_batches(docs.sparkSession):
        size = corpus_size(docs, text_col)
        return RankedIndex(saved(rows.mapInArrow(_index(*size, shard_bytes), schema), "none", **_ROW_GROUPS), *size)


def query_terms(text: Column) -> Column:
    """The distinct terms of a text; none of a null."""
    return F.array_distinct(F.regexp_extract_all(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), F.lit(f"({TERM})"), 1))


def _frequencies(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(wanted.value, pa.string())
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for ends, letters, starts in zip(*(batch.column(c) for c in ("ends", "letters", "starts")), strict=True):
                at = pc.index_in(terms, value_set=unpacked_terms(ends, letters)).fill_null(-1).to_numpy()
                total += np.where(at >= 0, np.append(np.diff(np.frombuffer(unpacked(starts), np.int64)), 0)[at], 0)
        some = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    return run


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, queries = shared.value
        names = pa.array(names, pa.string())
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("ids")[i].values
                at = pc.index_in(names, value_set=unpacked_terms(batch.column("ends")[i], batch.column("letters")[i])).fill_null(-1).to_numpy()
                tree = WaveletTree(len(ids), *(unpacked(batch.column(c)[i]) for c in _TREE))
                asked, docs, scores = [], [], []
                for query, terms in queries:
                    own = at[terms]
                    found = tree.top(own[own >= 0], weights[terms[own >= 0]], k)
                    asked += [query] * len(found)
                    docs += [d for _, d in found]
                    scores += [s for s, _ in found]
                shard = pa.array([batch.column("shard")[i].as_py()] * len(docs), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(asked, pa.int64()), shard, ids.take(pa.array(docs, pa.int64())), pa.array(scores, pa.int64())], names=["_q", "_shard", "_id", "_score"])

    return run


def search(
    index: RankedIndex, queries: DataFrame, k: int = TOP, query_id: str = "item_id", query_text: str = "text", id_col: str = "doc_id", block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """The k documents of highest score for each query: its id, rank (from 1), the document's id, score.

    A score is the sum over the query's distinct terms of weight * impact, in whole numbers; documents that score 0 are left out, equal scores go by the document's
    id, null last. Each shard gives its own k best of each query, exactly, and of those the best are taken, first within lanes of shards and then over all. Queries
    go through the index in blocks of some block_terms terms; a block with its documents' counts is what is broadcast. Every row of queries is a query of
    its own, so an id that repeats is answered for each of its rows. A query without a term, and an index without documents, give no rows.
    """
    spark = queries.sparkSession
    asked = saved(queries.select(F.col(query_id).alias("_query"), query_terms(F.col(query_text)).alias("_terms")))
    asked = saved(asked.withColumn("_q", F.monotonically_increasing_id()))
    shards, size = index.shards.count(), asked.agg(F.coalesce(F.sum(F.size("_terms")), F.lit(0))).first()[0]
    blocks, out = max(1, -(-size // block_terms)), []
    kind = index.shards.schema["ids"].dataType.elementType.simpleString()
    for b in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("_q"), F.lit(blocks)) == b).select("_q", "_terms").collect()
        names = list(dict.fromkeys(chain.from_iterable(r["_terms"] for r in rows)))
        place = {t: i for i, t in enumerate(names)}
        wanted = spark.sparkContext.broadcast(names)
        with small_batches(spark):
            told = index.shards.select("ends", "letters", "starts").mapInArrow(_frequencies(wanted), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
        weights = np.zeros(len(names), np.int64)
        for r in told:
            weights[r["term"]] = term_weight(r["df"], index.docs)
        shared = spark.sparkContext.broadcast((names, weights, [(r["_q"], np.array([place[t] for t in r["_terms"]], np.int64)) for r in rows]))
        with small_batches(spark):
            out.append(saved(index.shards.mapInArrow(_search(shared, k), f"_q long, _shard long, _id {kind}, _score long")))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    lane = F.pmod(F.xxhash64("_shard"), F.lit(max(1, math.isqrt(shards))))
    order = [F.col("_score").desc(), F.col("_id").asc_nulls_last(), F.col("_shard")]
    within = found.withColumn("_nth", F.row_number().over(Window.partitionBy("_q", lane).orderBy(*order))).filter(F.col("_nth") <= k)
    best = within.withColumn("_rank", F.row_number().over(Window.partitionBy("_q").orderBy(*order))).filter(F.col("_rank") <= k)
    return best.join(asked.select("_q", "_query"), "_q").select(
        F.col("_query").alias(query_id), F.col("_rank").alias("rank"), F.col("_id").alias(id_col), F.col("_score").alias("score")
    )


def op13_ranked(spark, sf_dir: str) -> DataFrame:
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


_SQL_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{TERM}')"
OP13_SQL = f"""
with words as (select doc_id, unnest({_SQL_TERMS}) as term from documents),
counted as (select doc_id, term, count(*) as tf from words group by doc_id, term),
sized as (select doc_id, count(*) as n from words group by doc_id),
whole as (select count(*) as docs, sum(n)::bigint as terms from sized),
weighed as (select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w from counted, whole group by term, docs),
asked as (select distinct item_id, unnest({_SQL_TERMS}) as term from benchmark),
scored as (
  select a.item_id, c.doc_id, sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 20 * (50 + (50 * s.n * whole.docs) // whole.terms))))::bigint as score
  from asked a join counted c using (term) join weighed w using (term) join sized s using (doc_id), whole group by a.item_id, c.doc_id),
ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= {TOP}
"""
