import random
import re
from collections import defaultdict

import numpy as np
import pytest

from quillon.llm import mixing
from quillon.llm.mixing import mix_sources, op6_mixing, pivot, source_targets


def fill(sizes, weights=(5, 2, 1), cap=3):
    """Targets by the rule as it is told: reshare what stops until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, out = set(), {}
    while True:
        mass = sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        rest = sum(weight[s] for s in names if s not in full)
        out = {s: cap * sizes[s] if s in full else mass * weight[s] / rest for s in names}
        more = {s for s in names if s not in full and out[s] > cap * sizes[s] + 1e-9}
        if not more:
            return out
        full |= more


def test_targets_against_the_rule(spark):
    rng = random.Random(6)
    for _ in range(6):
        sizes = {None if i == 7 else f"s{i}é"[: rng.randrange(2, 4)]: rng.choice([0, 1, 10, 1000, rng.randrange(10**6)]) for i in range(rng.randrange(1, 9))}
        got = source_targets(spark.createDataFrame(list(sizes.items()), "_source string, _size long"), (5, 2, 1), 3).collect()
        want = fill(sizes)
        assert {r["_source"]: r["_target"] for r in got} == pytest.approx(want)


def test_pivot_keeps_words_and_expectation():
    rng = np.random.default_rng(7)
    size, p = rng.integers(1, 50, 40), rng.random(40)
    total, runs = np.zeros(40), 3000
    for _ in range(runs):
        got, open_ = pivot(size, p, rng.random(40))
        assert np.isclose((size * got).sum(), (size * p).sum())
        settled = np.delete(got, open_) if open_ >= 0 else got
        assert set(settled) <= {0.0, 1.0}
        total += got
    assert np.abs(total / runs - p).max() < 0.05


def test_mix_of_documents(spark, sf_dir):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op6_mixing(spark, sf_dir).collect()
    size = {i: len(re.findall(rb"[^\x20\x09-\x0D]+", (r["text"] or "").encode())) for i, r in docs.items()}
    by_source = defaultdict(int)
    for i, r in docs.items():
        by_source[r["source"]] += size[i]
    want, taken, largest = fill(dict(by_source)), defaultdict(int), defaultdict(int)
    assert len(got) == len(docs)
    for r in got:
        s = docs[r["doc_id"]]["source"]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], by_source[s]) and r["target"] == pytest.approx(want[s])
        assert r["taken"] in {k * r["size"] for k in range(4)}
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6 for s in want)
    assert sorted(got) == sorted(op6_mixing(spark, sf_dir).collect())


def test_many_leaves_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF_ROWS", 16)
    monkeypatch.setattr(mixing, "FANOUT", 3)
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 30)), "hot" if i % 3 else "cold", "c") for i in range(900)]
    rows += [(None, None, None, "c"), (5, "", None, "c"), (6, "x " * 20_000, None, "c"), (6, "x " * 20_000, None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _size string")
    got = mix_sources(docs).collect()
    assert len(got) == len(rows) and all(r["taken"] <= 3 * r["size"] for r in got)
    totals = defaultdict(lambda: [0, 0.0, 0])
    for r in got:
        t = totals[r["source_size"]]
        t[0], t[1], t[2] = t[0] + r["taken"], r["target"], max(t[2], r["size"])
    assert len(totals) == 3 and all(abs(a - b) <= 2 * c for a, b, c in totals.values())  # a repeated row is decided twice over
    assert mix_sources(docs.limit(0)).count() == 0
