import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quillon.llm.decontaminate import OP7_SQL, find_leaks, op7_decontaminate
from quillon.llm import shingle_dedup, simhash
from quillon.llm.shingle_dedup import bucket_links, shingle_duplicates
from quillon.llm.simhash import SEED, chain_start, components, fingerprint, forest, near_duplicates, near_edges, op4_simhash, ring_keys

from ..compare import duckdb_rows, rows_of


def plain_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[k : k + width]) for k in range(max(len(words) - width + 1, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def union(ids, links):
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def test_simhash_against_all_pairs(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in docs.items()}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    root = union(prints, links)
    got = op4_simhash(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{p:016x}", root[i]) for i, p in prints.items()}


def test_fingerprint_white_space_and_short_texts():
    for text in ("", " \t\n", "one", "One two", "a\x0bb\x0cc\rd", "É é x y", "a b c d e f g " * 50):
        assert fingerprint(text.encode()) == plain_fingerprint(text)


def _near(rng, x, most):
    for b in rng.sample(range(64), rng.randrange(most + 1)):
        x ^= 1 << b
    return x


@pytest.mark.parametrize("budget", [1, 2, 3, 5])
def test_near_pairs_share_a_ring_key(spark, budget):
    rng = random.Random(budget)
    pairs = [(x, _near(rng, x, budget)) for x in (rng.getrandbits(64) for _ in range(400))]
    signed = [tuple(int(np.uint64(v).astype(np.int64)) for v in p) for p in pairs]
    df = spark.createDataFrame(signed, "a long, b long")
    assert df.filter(~F.arrays_overlap(ring_keys(F.col("a"), budget), ring_keys(F.col("b"), budget))).count() == 0
    if 64 % (budget + 1) == 0:
        assert chain_start(np.array([a ^ b for a, b in pairs], np.uint64), budget).all()


def test_blocks_and_forest_lose_no_link(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = sorted({_near(rng, b, 4) for b in base for _ in range(60)})
    links = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3]
    want = union(fps, links)
    assert {k: v for k, v in union(fps, [(int(a), int(b)) for a, b in forest(np.array(fps, np.uint64), 3)]).items()} == want
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "_fp long")
    for block in (5, 4096):
        got = [(r[0] % 2**64, r[1] % 2**64) for r in near_edges(df, 3, block).collect()]
        assert union(fps, got) == want and len(got) < 20 * len(fps)


@pytest.mark.parametrize("hub_edges", [1, 1 << 20])
def test_components_of_random_graphs(spark, monkeypatch, hub_edges):
    monkeypatch.setattr(simhash, "HUB_EDGES", hub_edges)  # at 1, nodes with over HUB_SHARE of the edges are hubs
    monkeypatch.setattr(simhash, "HUB_SHARE", 0.02)
    rng = random.Random(10)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    links += [(2000, 2001 + i) for i in range(50)] + [(3000 + i, 2900) for i in range(50)]
    nodes = {x for a, b in links if a != b for x in (a, b)}
    got = {r["_node"]: r["_root"] for r in components(spark.createDataFrame(links, "_u long, _v long")).collect()}
    assert got == {k: v for k, v in union(nodes, [x for x in links if x[0] != x[1]]).items()}


def _family(rng, n, words=60):
    """A chain of texts, each with a word or two of the one before replaced, so that ends are far apart."""
    text = [f"w{rng.randrange(10**5)}" for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(text)
        for _ in range(rng.randrange(1, 3)):
            text[rng.randrange(words)] = f"x{rng.randrange(10**5)}"
        out.append(text)
    return out


def _shingles(words, width=5):
    return frozenset(" ".join(words[k : k + width]) for k in range(max(len(words) - width + 1, 1)))


@pytest.mark.parametrize("block", [2000, 8 << 20])
def test_similar_documents_against_all_pairs(spark, block):
    rng = random.Random(33)
    texts = [t for _ in range(4) for t in _family(rng, 60)] + [t for _ in range(30) for t in _family(rng, 2, 25)] + [["a"], ["a"], [], ["b", "c"]]
    rng.shuffle(texts)
    sets = [_shingles(t) if t else frozenset() for t in texts]
    links = [(a, b) for b in range(len(texts)) for a in range(b) if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in shingle_duplicates(docs, block=block).collect()}
    assert got == union(range(len(texts)), links) and len(links) > 100


def test_similar_documents_are_met_by_fingerprints_first(spark, monkeypatch):
    """Each two fingerprints of sets within 3 bits are linked, as all pairs say, and only what the sets bear out is kept."""
    rng, seen, real = random.Random(35), [], near_edges

    def spy(fps, budget, *more):
        edges = real(fps, budget, *more)
        seen.append(({r[0] % 2**64 for r in fps.collect()}, budget, [(r[0] % 2**64, r[1] % 2**64) for r in edges.collect()]))
        return edges

    monkeypatch.setattr(shingle_dedup, "near_edges", spy, raising=False)
    texts = []
    for n in range(60):
        text = [f"w{rng.randrange(10**5)}" for _ in range(400)]
        texts += [text, text[:-1] + [f"x{n}"], text + ["y"] * (1 + n % 3)]
    texts += [[], ["a"], ["b"]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, width=5, least=0.8).collect()}

    def plain(words):
        hashes = [xxhash.xxh64_intdigest(s.encode(), SEED) for s in _shingles(words)]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if words else 0

    fps = {plain(t) for t in texts}
    links = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3]
    assert [(f, b) for f, b, _ in seen] == [(fps, 3)] and len(links) > 40
    assert union(fps, seen[0][2]) == union(fps, links)
    assert got == {i: i - i % 3 if i < 180 else i for i in range(len(texts))}


def test_bucket_links_find_what_all_pairs_do():
    rng = random.Random(34)
    for _ in range(30):
        sets = [np.unique(np.array([rng.randrange(60) for _ in range(rng.randrange(1, 30))], np.uint64)) for _ in range(25)]
        roots = np.array([rng.randrange(12) for _ in sets])
        same = [(a, b) for a in range(25) for b in range(a) if roots[a] == roots[b]]
        near = [(a, b) for a in range(25) for b in range(a) if len(np.intersect1d(sets[a], sets[b])) >= 0.5 * len(np.union1d(sets[a], sets[b]))]
        got = bucket_links(sets, roots, 0.5)
        assert all((max(x), min(x)) in near for x in got) and union(range(25), same + got) == union(range(25), same + near)


def test_near_duplicates_odd_rows(spark):
    rows = [(3, None, 1), (2, "", 1), (9, " ", 1), (None, "a b c d", 1), (5, "A b  C d", 1), (5, "a b c d", 1), (7, "x y z " * 30_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _fp int")
    got = sorted((str(r["doc_id"]), r["component_id"]) for r in near_duplicates(docs).collect())
    assert got == [("2", 2), ("3", 2), ("5", 5), ("5", 5), ("7", 7), ("9", 2), ("None", 5)]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_leaks_equal_sql(spark, sf_dir):
    assert rows_of(op7_decontaminate(spark, sf_dir)) == duckdb_rows(OP7_SQL, sf_dir)


def plain_leaks(docs, items, window=10):
    import re

    words = lambda t: [w for w in re.split("[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or "")) if w]
    out = {}
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for k, x in items:
            v = words(x)
            n = min(window, len(v))
            runs = {tuple(v[s : s + n]) for s in range(len(v) - n + 1)} if v else set()
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in runs:
                    hit |= set(range(s, s + n))
                    found.add(str(k))
        out[i] = (len(w), len(hit), sorted(found))
    return out


@pytest.mark.parametrize("max_windows", [3, 100_000])
def test_leaks_against_plain_search(spark, max_windows):
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(12)] + ["É", "é", "10"]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(n))) for k, n in enumerate([1, 2, 3, 4, 5, 9, 10, 11, 25, 25])] + [(77, None), (78, " .. ")]
    docs = []
    for i in range(60):
        text = [rng.choice(vocab) for _ in range(rng.randrange(40))]
        if i % 2:
            part = items[rng.randrange(10)][1].split()
            at = rng.randrange(len(text) + 1)
            text[at:at] = part[rng.randrange(len(part)) :] if i % 4 == 1 else part
        docs.append((i, " - ".join(text).upper() if i % 3 == 0 else " ".join(text)))
    docs += [(100, None), (101, ""), (102, "...")]
    table = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, _pos int")
    got = find_leaks(table, spark.createDataFrame(items, "item_id long, text string"), max_windows=max_windows).collect()
    want = plain_leaks(docs, items)
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"]) for r in got} == want and all(r["contaminated"] == (r["n_hit"] > 0) for r in got)


def test_leaks_without_items_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    got = find_leaks(docs, none).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["contaminated"]) for r in got) == [("1", 2, False), ("None", 1, False)]
    assert find_leaks(docs.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
