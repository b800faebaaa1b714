"""SimHash near-dedup: fingerprints, pigeonring candidates, full Hamming check, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import saved, table
from .textbytes import each_text

SEED = 42
BITS = 64
#: Fingerprints of a bucket that are compared with each other at once; larger buckets are cut into blocks.
BLOCK = 4096
#: Shingles whose bits are counted at once.
VOTES = 1 << 16


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """A hash for each shingle of the text, repeats included; a text of fewer words is one shingle, no words are none."""
    words = text.lower().split()  # both look at ASCII only, and split at \x20 and \x09-\x0D
    if not words:
        return np.zeros(0, "<u8")
    n = max(len(words) - width + 1, 1)
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[min(width, len(words)) - 1 :] - 1).tolist()
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    return np.array([digest(view[a:b], SEED) for a, b in zip(starts, stops, strict=True)], dtype="<u8")


def bits_of(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; none: 0."""
    n, votes = len(hashes), np.zeros(BITS, np.int64)
    for at in range(0, n, VOTES):
        part = hashes[at : at + VOTES]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, width: int = 3) -> int:
    return bits_of(shingle_hashes(text, width))


def _fingerprints(width: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = np.fromiter((fingerprint(t, width) for t in each_text(texts)), dtype=np.uint64, count=len(texts))
            yield pa.array(found.view(np.int64))

    return F.arrow_udf(run, "long")


def with_fingerprint(docs: DataFrame, text_col: str = "text", width: int = 3, name: str = "_fp") -> DataFrame:
    """docs with the fingerprint of text_col as a long (the same 64 bits)."""
    return docs.withColumn(name, _fingerprints(width)(F.col(text_col).cast("string")))


def _bits(fp: Column, at: int, n: int) -> Column:
    """n bits from at, around the ring of 64."""
    low = F.shiftrightunsigned(fp, at % BITS)
    both = low if at % BITS + n <= BITS else low.bitwiseOR(F.shiftleft(fp, BITS - at % BITS))
    return both.bitwiseAND(F.lit((1 << n) - 1))


def ring_keys(fp: Column, budget: int) -> Column:
    """Keys of which two fingerprints within budget bits share one at least.

    The ring of 64 bits has m = budget + 1 segments. By the pigeonring principle some segment
    starts a chain in which each first l segments differ in l * budget / m bits at most: the first
    segment in none, the first two in one. One half of the second segment is then equal as well,
    so a key is a segment and a half of the next. Each of the m starts gives two keys.
    """
    m = budget + 1
    seg = BITS // m
    half = seg // 2
    keys = []
    for i in range(m):
        head, at = _bits(fp, i * seg, seg), (i + 1) * seg
        for k, off in enumerate((0, half)):
            tail = _bits(fp, at + off, half)
            keys.append(F.xxhash64(F.lit(2 * i + k), head, tail) if seg + half > 40 else (F.lit(2 * i + k).cast("long") * (1 << 40)) + head * (1 << half) + tail)
    return F.array(*keys)


def chain_start(diff: np.ndarray, budget: int) -> np.ndarray:
    """Which differences have a chain of all m segments that stays within its budgets from start to end."""
    m = budget + 1
    seg = BITS // m
    mask = np.uint64((1 << seg) - 1)
    parts = [np.bitwise_count((diff >> np.uint64(i * seg)) & mask) for i in range(m)]
    good = np.zeros(diff.shape, bool)
    for i in range(m):
        total, fine = np.zeros(diff.shape, np.uint8), np.ones(diff.shape, bool)
        for l in range(1, m + 1):  # noqa: E741
            total = total + parts[(i + l - 1) % m]
            fine &= total <= l * budget // m
        good |= fine
    return good


def linked_to(one: np.uint64, others: np.ndarray, budget: int) -> np.ndarray:
    """Places of others that pass the chain test and then the full Hamming check against one."""
    diff = others ^ one
    at = np.flatnonzero(chain_start(diff, budget)) if BITS % (budget + 1) == 0 else np.arange(len(others))
    return at[np.bitwise_count(diff[at]) <= budget]


def forest(fps: np.ndarray, budget: int) -> list[tuple[int, int]]:
    """For each group of fps that links join: (member, smallest member) for its other members."""
    if len(fps) == 2:
        a, b = fps
        return [(max(a, b), min(a, b))] if len(linked_to(a, fps[1:], budget)) else []
    left, out = np.sort(fps), []
    while len(left):
        root, left, frontier = left[0], left[1:], [left[0]]
        while frontier and len(left):
            at = linked_to(frontier.pop(), left, budget)
            if len(at):
                out += [(x, root) for x in left[at]]
                frontier += list(left[at])
                left = np.delete(left, at)
    return out


def _bucket_edges(budget: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by (_key, _one, _two); a bucket may go over the end of a batch."""
        rest: pd.DataFrame | None = None

        def edges(rows: pd.DataFrame) -> pd.DataFrame:
            key = rows[["_key", "_one", "_two"]].to_numpy()
            fps = rows["_fp"].to_numpy().view(np.uint64)
            cuts = np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(key)]))
            many = np.flatnonzero(np.diff(cuts) > 1)
            found = [e for k in many for e in forest(fps[cuts[k] : cuts[k + 1]], budget)]
            pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pd.DataFrame({"_u": pairs[:, 0], "_v": pairs[:, 1]})

        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(rows):
                continue
            last = (rows[["_key", "_one", "_two"]] == rows[["_key", "_one", "_two"]].iloc[-1]).all(axis=1).to_numpy()
            head = int(np.argmax(last))
            rest = rows.iloc[head:].reset_index(drop=True)
            if head:
                yield edges(rows.iloc[:head])
        if rest is not None and len(rest):
            yield edges(rest)

    return run


def near_edges(fps: DataFrame, budget: int, block: int = BLOCK) -> DataFrame:
    """(_u, _v) between distinct fingerprints (_fp): not all links, but a tree for all that links join.

    A bucket is what shares a ring key. One of over block fingerprints is cut into blocks by a hash, and
    each pair of its blocks is a bucket of its own, so a task holds two blocks at most and no link is lost.
    """
    keyed = fps.select("_fp", F.explode(ring_keys(F.col("_fp"), budget)).alias("_key"))
    hot = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > block)
    hot = hot.select("_key", F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    own = F.pmod(F.xxhash64("_fp"), F.coalesce("_blocks", F.lit(1))).cast("int")
    dealt = (
        keyed.join(hot, "_key", "left")
        .select("_fp", "_key", own.alias("_own"), F.explode(F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1)).alias("_other"))
        .select("_key", F.least("_own", "_other").cast("long").alias("_one"), F.greatest("_own", "_other").cast("long").alias("_two"), "_fp")
    )
    return (
        dealt.repartition("_key", "_one", "_two")
        .sortWithinPartitions("_key", "_one", "_two")
        .mapInPandas(_bucket_edges(budget), "_u long, _v long")
        .distinct()
    )


#: From this many edges on, a node with over HUB_SHARE of them is met by a broadcast: 2 / HUB_SHARE nodes at most.
HUB_EDGES, HUB_SHARE = 1 << 20, 1e-3


def components(edges: DataFrame) -> DataFrame:
    """(_u, _v) to (_node, _root) for each node that has an edge; the root is the smallest node it reaches.

    Alternating stars: each node's larger neighbours move to its smallest neighbour, then each
    node's smaller ones do. Minima fold before the shuffle. The minima of nodes with over HUB_SHARE of the edges are broadcast
    once there are HUB_EDGES, so that no task gets all edges of a hub. The rounds end when a round leaves the edges as they were; their number
    grows with the logarithm of the longest path.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select(F.col("_v"), F.col("_u"))) if large else e
        least = both.groupBy("_u").agg(F.min("_v").alias("_m"), F.count(F.lit(1)).alias("_n"))
        if seen[0] < HUB_EDGES:
            met = both.join(least, "_u")
        else:
            hubs = least.filter(F.col("_n") > HUB_SHARE * seen[0])
            rest = both.join(F.broadcast(hubs.select("_u")), "_u", "left_anti").join(least.filter(F.col("_n") <= HUB_SHARE * seen[0]), "_u")
            met = both.join(F.broadcast(hubs), "_u").unionByName(rest)
        met = met.select("_u", "_v", F.least("_u", "_m").alias("_m"))
        if large:
            return met.filter(F.col("_v") > F.col("_u")).select(F.col("_v").alias("_u"), F.col("_m").alias("_v")).distinct()
        moved = met.filter(F.col("_v") != F.col("_m")).select(F.col("_v").alias("_u"), F.col("_m").alias("_v"))
        return moved.union(met.select("_u", F.col("_m").alias("_v"))).filter(F.col("_u") != F.col("_v")).distinct()

    def mark(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("_u", "_v")), F.lit(0))).first())

    now = saved(edges.filter(F.col("_u") != F.col("_v")).select(F.greatest("_u", "_v").alias("_u"), F.least("_u", "_v").alias("_v")).distinct())
    was, seen = None, mark(now)
    while seen != was and seen[0]:
        was = seen
        now = saved(star(star(now, True), False))
        seen = mark(now)
    return now.select(F.col("_u").alias("_node"), F.col("_v").alias("_root")).union(now.select("_v", "_v").distinct())


def near_duplicates(
    docs: DataFrame, budget: int = 3, width: int = 3, least: float | None = None, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id.

    Documents link when their fingerprints differ in budget bits at most; component_id is the
    smallest id that links reach, the document's own included. Exact copies and other documents
    with one fingerprint fold into one row before candidates are made, so copies make no pairs.

    With least, documents link when their sets of shingles have that Jaccard similarity, and the row has id and component_id. What fingerprints of the sets link
    within budget bits, by the same candidates and the same Hamming check, is then checked on the sets. 64 bits cannot reach the rest (at 0.8 some 10 bits differ, and a ring of
    segments that short keeps nearly all pairs), so pairs that this leaves apart have candidates of their own: see shingle_duplicates.

    A null or blank text has the fingerprint 0 and links like any other. Whole texts are hashed,
    of any length. A null id is never the smallest while another id is there. Rows that repeat an id give
    a row each. Other columns of the input are not read. An empty table gives an empty result.
    """
    if not 0 <= budget < 16:
        raise ValueError("budget is 0 to 15 bits")
    if least is not None:
        from .shingle_dedup import shingle_duplicates  # it takes components() from here

        return shingle_duplicates(docs, width, least, budget=budget, id_col=id_col, text_col=text_col)
    prints = saved(
        with_fingerprint(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text", width).select("_id", "_fp")
    )
    distinct = saved(prints.groupBy("_fp").agg(F.min("_id").alias("_first")))
    joined = components(near_edges(distinct, budget, block))
    root = distinct.join(joined, distinct["_fp"] == joined["_node"], "left").select(
        "_fp", "_first", F.coalesce("_root", "_fp").alias("_root")
    )
    first = root.groupBy("_root").agg(F.min("_first").alias("_component"))
    named = root.select("_fp", "_root").join(first, "_root").select("_fp", "_component")
    return prints.join(named, "_fp").select(
        F.col("_id").alias(id_col),
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("_component").alias("component_id"),
    )


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
