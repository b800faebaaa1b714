"""Near duplicates by word shingles: SimHash links, MinHash bands for pairs too many bits apart, exact Jaccard check of both, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import saved
from .lm_score import mixed
from .simhash import SEED, bits_of, components, near_edges, shingle_hashes
from .textbytes import each_text

#: Words of a shingle, and the least share of shingles that two near duplicates have in common.
WIDTH, LEAST = 5, 0.8
#: Bands of ROWS minima: a pair at 0.8 shares one with probability 1 - (1 - 0.8 ** ROWS) ** BANDS = 0.99993.
BANDS, ROWS = 24, 5
#: Bytes of the sets of a bucket that are in a task at once, twice over.
BLOCK_BYTES = 8 << 20
#: Shingles whose minima are taken at once.
CHUNK = 2048

_MASKS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = mixed(_MASKS) | np.uint64(1)


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; a text of fewer words is one shingle, no words are none."""
    return np.unique(shingle_hashes(text, width))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), CHUNK):
        part = (hashes[at : at + CHUNK, None] ^ _MASKS) * _FACTORS
        least = np.minimum(least, part.min(axis=0))
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + least.reshape(BANDS, ROWS)[:, k])
    return key.view(np.int64)


def short_set(hashes: np.ndarray) -> bytes:
    """The set in 32 bits a shingle, sorted: what is sent to be compared."""
    return np.unique((hashes >> np.uint64(32)).astype("<u4")).tobytes()


def _set_name(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED)


def _sets(width: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names, packed = np.zeros(len(texts), np.uint64), []
            for i, text in enumerate(each_text(texts)):
                hashes = shingle_set(text, width)
                names[i] = _set_name(hashes)
                packed.append(short_set(hashes))
            yield pa.StructArray.from_arrays([pa.array(names.view(np.int64)), pa.array(packed, pa.binary())], names=["set", "hashes"])

    return F.arrow_udf(run, "struct<set:long,hashes:binary>").asNondeterministic()  # a null test of it, pushed below, would run it twice


def _prints(width: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names, prints, keys = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64), np.zeros((len(texts), BANDS), np.int64)
            for i, text in enumerate(each_text(texts)):  # one set at a time is in memory
                hashes = shingle_set(text, width)
                names[i], prints[i], keys[i] = _set_name(hashes), bits_of(hashes), band_keys(hashes)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1)))
            yield pa.StructArray.from_arrays([pa.array(names.view(np.int64)), pa.array(prints.view(np.int64)), lists], names=["set", "fp", "keys"])

    return F.arrow_udf(run, "struct<set:long,fp:long,keys:array<long>>")


def jaccard(one: pa.Array, two: pa.Array) -> pa.Array:
    out = []
    for a, b in zip(one, two, strict=True):
        x, y = np.frombuffer(a.as_buffer(), "<u4"), np.frombuffer(b.as_buffer(), "<u4")
        both = len(np.intersect1d(x, y, assume_unique=True))
        out.append(both / max(len(x) + len(y) - both, 1))
    return pa.array(out, pa.float64())


def simhash_pairs(distinct: DataFrame, budget: int) -> DataFrame:
    """(_u, _v), pairs of sets (_set, _fp) that their fingerprints link: a tree for all sets that such links join.

    Sets of one fingerprint meet the first of them, and the first ones meet as near_edges (ring keys, chain test, Hamming check) says.
    """
    firsts = saved(distinct.groupBy("_fp").agg(F.min("_set").alias("_first")))
    same = distinct.join(firsts, "_fp").filter("_set != _first").select(F.col("_set").alias("_u"), F.col("_first").alias("_v"))
    one, two = (firsts.select(F.col("_fp").alias(n), F.col("_first").alias(f"{n}s")) for n in ("_u", "_v"))
    near = near_edges(firsts.select("_fp"), budget).join(one, "_u").join(two, "_v").select(F.col("_us").alias("_u"), F.col("_vs").alias("_v"))
    return same.union(near)


def _apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs (_u, _v) whose ends joined has not joined."""
    root = joined.select(F.col("_node").alias("_n"), F.col("_root").alias("_r"))
    for end in ("_u", "_v"):
        pairs = pairs.join(root, F.col(end) == F.col("_n"), "left").withColumn(f"{end}r", F.coalesce("_r", end)).drop("_n", "_r")
    return pairs.filter("_ur != _vr").select("_u", "_v")


def _merged(joined: DataFrame | None, edges: DataFrame) -> DataFrame:
    """(_node, _root) after edges join what joined (the same, or None) has joined so far: only the roots that edges touch are worked on."""
    if joined is None:
        return saved(components(edges))
    root = joined.select(F.col("_node").alias("_n"), F.col("_root").alias("_r"))
    for end in ("_u", "_v"):
        edges = edges.join(root, F.col(end) == F.col("_n"), "left").withColumn(end, F.coalesce("_r", end)).drop("_n", "_r")
    moved = components(edges).select(F.col("_node").alias("_n"), F.col("_root").alias("_r"))
    old = joined.join(moved, F.col("_root") == F.col("_n"), "left").select("_node", F.coalesce("_r", "_root").alias("_root"))
    new = moved.join(joined, F.col("_n") == F.col("_node"), "left_anti").select(F.col("_n").alias("_node"), F.col("_r").alias("_root"))
    return saved(old.union(new))


def bucket_links(sets: list[np.ndarray], roots: np.ndarray, least: float) -> list[tuple[int, int]]:
    """A tree of links between the members of a bucket that roots keep apart: all such pairs of members are looked at, through an index of their shingles.

    Members of the group that is largest at first are met from the side of the others, so what is done follows the number of others.
    """
    size, owner = np.array([len(s) for s in sets]), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    rank = np.cumsum(np.concatenate(([0], flat[order][1:] != flat[order][:-1]))) if len(flat) else np.zeros(0, int)
    start = np.searchsorted(rank, np.arange(rank[-1] + 2 if len(rank) else 1))
    place, own = np.zeros(len(flat), np.int64), owner[order]
    place[order] = rank
    first = np.concatenate(([0], np.cumsum(size)))
    _, label, held = np.unique(roots, return_inverse=True, return_counts=True)
    label, big, links = label.astype(np.int64), int(held.argmax()), []
    for m in np.argsort(held[label], kind="stable"):
        if label[m] == big:
            continue
        runs = place[first[m] : first[m + 1]]
        lens = start[runs + 1] - start[runs]
        at = np.repeat(start[runs] - np.concatenate(([0], np.cumsum(lens)[:-1])), lens) + np.arange(lens.sum())
        both = np.bincount(own[at], minlength=len(sets))
        near = np.flatnonzero((label != label[m]) & (both >= least * (size[m] + size - both)))
        for x in near:
            if label[x] != label[m]:
                links.append((int(m), int(x)))
                mine, other = (label[x], label[m]) if label[x] == big else (label[m], label[x])
                label[label == other] = mine
    return links


def _open_links(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (_key, _one, _two); a bucket may go over the end of a batch."""

        def found(held: list[tuple]) -> list[tuple[int, int]]:
            if len({r[1] for r in held}) < 2:
                return []
            got = bucket_links([np.frombuffer(h, "<u4") for _, _, h in held], np.array([r[1] for r in held]), least)
            return [(held[i][0], held[j][0]) for i, j in got]

        now, held = None, []
        for batch in batches:
            out: list[tuple[int, int]] = []
            for *key, one, root, h in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                if key != now:
                    out += found(held)
                    now, held = key, []
                held.append((one, root, h))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["_u", "_v"])
        out = found(held)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["_u", "_v"])

    return run


def shingle_duplicates(
    docs: DataFrame, width: int = WIDTH, least: float = LEAST, block: int = BLOCK_BYTES, budget: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, component_id, the smallest id that links reach, the document's own included.

    Documents link when least of their distinct shingles of width words are common to both (Jaccard), which is
    checked on the whole sets (hashes of 32 bits). Texts with one set fold into one row before candidates are made. What SimHash links, fingerprints of sets within budget
    bits, is checked first. Candidates for the rest share a band, so that a link of more bits, or one whose tree of SimHash links the check breaks, is not lost:
    those that are not joined yet are checked against one member of the bucket. In a bucket of which that leaves several groups, members of
    different groups are then checked with each other in the task that holds their sets, so that pairs are no rows; a bucket of over block
    bytes is cut into blocks by a hash, and each pair of its blocks is a bucket of its own. A null or blank text has the empty set. A null id
    is never the smallest while another id is there. Rows that repeat an id give a row each.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("_id"), _prints(width)(text).alias("_p"))
    prints = saved(rows.select("_id", F.col("_p.set").alias("_set"), F.col("_p.fp").alias("_fp"), F.col("_p.keys").alias("_keys")))
    distinct = saved(prints.groupBy("_set").agg(F.min("_id").alias("_first"), F.first("_fp").alias("_fp"), F.first("_keys").alias("_keys")))
    linked = saved(simhash_pairs(distinct.select("_set", "_fp"), budget))
    keyed = distinct.select("_set", F.explode("_keys").alias("_key"))
    shared = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.min_by("_set", F.xxhash64("_set")).alias("_lead")).filter("_n > 1")
    keyed = saved(keyed.join(shared, "_key").select("_key", "_set", "_n", "_lead"))
    every = docs.select(_sets(width)(text).alias("_s")).select(F.col("_s.set").alias("_set"), F.col("_s.hashes").alias("_hashes"))
    needed = keyed.select("_set").union(linked.select("_u")).union(linked.select("_v")).distinct()
    sets = saved(every.join(needed, "_set", "left_semi").dropDuplicates(["_set"]))

    def checked(pairs: DataFrame) -> DataFrame:
        return saved(pairs.join(one, "_u").join(two, "_v").filter(F.arrow_udf(jaccard, "double")("_uh", "_vh") >= least).select("_u", "_v"))

    pairs = keyed.filter("_set != _lead").select(F.greatest("_set", "_lead").alias("_u"), F.least("_set", "_lead").alias("_v")).distinct()
    one, two = (sets.select(F.col("_set").alias(n), F.col("_hashes").alias(f"{n}h")) for n in ("_u", "_v"))
    joined = _merged(None, checked(linked))
    joined = _merged(joined, checked(_apart(pairs, joined)))

    live = keyed.filter("_n > 2").join(joined, keyed["_set"] == joined["_node"], "left").select("_key", "_set", F.coalesce("_root", "_set").alias("_root"))
    live = live.join(sets.select("_set", F.octet_length("_hashes").alias("_bytes")), "_set")
    open_ = live.groupBy("_key").agg(F.min("_root").alias("_a"), F.max("_root").alias("_b"), F.ceil(F.sum("_bytes") / block).cast("int").alias("_blocks"))
    dealt = (
        live.join(open_.filter("_a < _b").select("_key", F.greatest("_blocks", F.lit(1)).alias("_blocks")), "_key")
        .select("_key", "_set", "_root", "_blocks", F.pmod(F.xxhash64("_set"), "_blocks").cast("int").alias("_own"))
        .select("_key", "_set", "_root", "_own", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other"))
        .select("_key", F.least("_own", "_other").alias("_one"), F.greatest("_own", "_other").alias("_two"), "_set", "_root")
        .join(sets, "_set").select("_key", "_one", "_two", "_set", "_root", "_hashes")
    )
    more = dealt.repartition("_key", "_one", "_two").sortWithinPartitions("_key", "_one", "_two").mapInArrow(_open_links(least), "_u long, _v long")
    more = saved(more.distinct())
    if not more.isEmpty():
        joined = _merged(joined, more)

    root = distinct.join(joined, distinct["_set"] == joined["_node"], "left").select("_set", "_first", F.coalesce("_root", "_set").alias("_root"))
    first = root.groupBy("_root").agg(F.min("_first").alias("_component"))
    named = root.join(first, "_root").select("_set", "_component")
    return prints.select("_id", "_set").join(named, "_set").select(F.col("_id").alias(id_col), F.col("_component").alias("component_id"))
