import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from quillon.llm import ranked
from quillon.llm.ranked import OP13_SQL, WaveletTree, build_index, build_tree, op13_ranked, search, term_places, term_weight

from ..compare import duckdb_rows, rows_of

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return PLAIN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, queries, k):
    """{place of the query: [(score, id)]} by scoring every document."""
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, length, df = len(counts), sum(c.total() for _, c in counts), Counter(t for _, c in counts for t in c)
    out = {}
    for q, text in enumerate(queries):
        found = []
        for i, c in counts:
            m = 50 + 50 * c.total() * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(plain_terms(text)) if c[t])
            if s > 0:
                found.append((s, i))
        out[q] = sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
    return out


def random_texts(rng, n, vocabulary):
    words = [f"w{i}" for i in range(vocabulary)]
    heavy = [1 / (i + 1) for i in range(vocabulary)]
    return [" ".join(rng.choices(words, heavy, k=rng.choice((0, 1, 3, 20, 60)))) for _ in range(n)]


def test_query_equals_sql(spark, sf_dir):
    assert rows_of(op13_ranked(spark, sf_dir)) == duckdb_rows(OP13_SQL, sf_dir)


def test_terms_of_bytes():
    text = "Über-ÄRA e2e, x_y\x00z\x7f日本 'S ЖЖ"
    low, start, end = term_places(np.frombuffer(text.encode(), np.uint8))
    assert [low[a:b].tobytes().decode() for a, b in zip(start, end, strict=True)] == plain_terms(text)


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65, 300])
def test_tree_gives_the_best_of_all_documents(n):
    rng = random.Random(n)
    texts = random_texts(rng, n, 40)
    texts += texts[: n // 2]  # copies: ties
    docs, length = sum(bool(plain_terms(t)) for t in texts), sum(len(plain_terms(t)) for t in texts)
    made = build_tree([t.encode() for t in texts], docs, length)
    names = {t: i for i, t in enumerate(made.pop("terms").to_pylist())}
    tree = WaveletTree(len(texts), *made.values())
    df = Counter(t for text in texts for t in set(plain_terms(text)))
    for k in (1, 5, 50):
        queries = [" ".join(rng.choices([f"w{i}" for i in range(45)], k=rng.randrange(1, 12))) for _ in range(20)]
        want = plain_search(list(enumerate(texts)), queries, k)
        for q, text in enumerate(queries):
            own = [t for t in dict.fromkeys(plain_terms(text)) if t in names]
            got = tree.top(np.array([names[t] for t in own], np.int64), np.array([term_weight(df[t], docs) for t in own], np.int64), k)
            assert got == want[q]


def test_search_opens_few_nodes():
    rng = random.Random(4)
    texts = random_texts(rng, 4000, 3000)
    docs, length = sum(bool(t) for t in texts), sum(len(t.split()) for t in texts)
    made = build_tree([t.encode() for t in texts], docs, length)
    names = {t: i for i, t in enumerate(made.pop("terms").to_pylist())}
    tree, opened, ones = WaveletTree(len(texts), *made.values()), [], WaveletTree.ones
    tree.ones = lambda level, at: opened.append(len(level)) or ones(tree, level, at)
    tree.top(np.array([names["w30"], names["w200"]]), np.array([3000, 5000]), 10)
    assert sum(opened) < 1200  # of 8,191


@pytest.mark.parametrize("shard_bytes", [1, 200, 1 << 24])
def test_search_of_odd_tables(spark, shard_bytes):
    rng = random.Random(11)
    texts = [None, "", "...", "Alpha beta", "alpha BETA", "alpha beta"] + ["same copy of alpha"] * 70 + random_texts(rng, 60, 30) + ["é" * 300 + " alpha " * 500]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)]
    rows += rows[40:44]  # repeated rows
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ids string, _score int")
    asked = [(1, "alpha"), (1, "beta alpha alpha"), (None, "w1 w2 w3"), (3, None), (4, "!!"), (5, "copy nowhere"), (6, "w0 " * 50)]
    queries = spark.createDataFrame([(i, t, 0) for i, t in asked], "item_id long, text string, rank int")
    got = search(build_index(docs.repartition(3), shard_bytes=shard_bytes), queries, k=12, block_terms=4).collect()
    want = plain_search(rows, [t for _, t in asked], 12)
    lists = Counter()
    by_query = defaultdict(list)
    for r in got:
        by_query[r["item_id"]].append((r["rank"], r["score"], r["doc_id"]))
    for item in {i for i, _ in asked}:
        expect = [(n, s, d) for q, (i, _) in enumerate(asked) if i == item for n, (s, d) in enumerate(want[q], 1)]
        lists[item] = len(expect)
        assert Counter(by_query[item]) == Counter(expect)
    assert lists[1] == 24 and lists[3] == lists[4] == 0


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    queries = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search(build_index(docs), queries).count() == 0
    some = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert search(build_index(some), queries.limit(0)).count() == 0


def test_tasks_hold_few_shards_at_once(spark, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(1 << 30)}" for _ in range(30_000)) for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    queries = spark.createDataFrame([(1, f"{texts[7][:50]} {texts[3][-50:]}")], "item_id long, text string")
    sizes, key = spark.sparkContext.accumulator(0), "spark.sql.execution.arrow.maxBytesPerBatch"

    def watched(made):
        def of(*args):
            run = made(*args)

            def told(batches):
                for batch in batches:
                    sizes.add(batch.num_rows)
                    assert batch.nbytes < 3 << 20
                    yield batch

            return lambda batches: run(told(batches))

        return of

    for name in ("_index", "_frequencies", "_search"):
        monkeypatch.setattr(ranked, name, watched(getattr(ranked, name)))
    before = spark.conf.get(key)
    index = build_index(docs, shard_bytes=300_000)
    assert spark.conf.get(key) == before
    groups = [pq.read_metadata(f.removeprefix("file://")) for f in index.shards.inputFiles()]
    assert sum(m.num_rows for m in groups) == 12
    assert all(m.row_group(i).total_byte_size < 3 << 20 for m in groups for i in range(m.num_row_groups))
    want = plain_search(list(enumerate(texts)), [f"{texts[7][:50]} {texts[3][-50:]}"], 50)[0]
    assert [(r["score"], r["doc_id"]) for r in search(index, queries).orderBy("rank").collect()] == want
    assert spark.conf.get(key) == before and sizes.value == 36
