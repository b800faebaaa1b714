import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.llm.merkle import OP11_SQL, fold, fold_proof, leaf_digest, levels_of, merkle_manifest, op11_merkle, sibling_rows

from ..compare import duckdb_rows, rows_of

H = lambda *parts: sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*fields):
    return H(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def plain_tree(nodes, fanout):
    """(root, the siblings of each leaf level by level), one level at a time over the whole list."""
    siblings, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, i in enumerate(at):
            run = range(i // fanout * fanout, min(i // fanout * fanout + fanout, len(level)))
            siblings[k] += [level[j] for j in run if j != i]
            at[k] = i // fanout
        level = [H(*level[i : i + fanout]) for i in range(0, len(level), fanout)]
    return level[0], siblings


def plain_manifest(rows, fanout=2):
    """(id, group, leaf, subroot, root, path) of rows (id, group, leaf), in any order."""
    groups = defaultdict(list)
    for i, g, leaf in rows:
        groups[g].append((i is not None, i, leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: (sorted(groups[g], key=lambda r: (r[0], r[1] or 0, r[2])),) for g in names}
    trees = {g: (kept, *plain_tree([r[2] for r in kept], fanout)) for g, (kept,) in trees.items()}
    root, above = plain_tree([trees[g][1] for g in names], fanout)
    return [(r[1], g, r[2], trees[g][1], root, "".join(s + up)) for g, up in zip(names, above, strict=True) for r, s in zip(trees[g][0], trees[g][2], strict=True)]


def test_merkle_equals_sql(spark, sf_dir):
    assert rows_of(op11_merkle(spark, sf_dir)) == duckdb_rows(OP11_SQL, sf_dir)


@pytest.mark.parametrize(("fanout", "block"), [(2, 4), (3, 9), (5, 4096)])
def test_manifest_equals_one_level_at_a_time(spark, fanout, block):
    # a hot group over many blocks, one of a power of the fan-out, lone leaves, a null group and an empty one, null and repeated ids, repeated rows
    rows = [(i // 2 if i % 7 else None, "hot", f"t{i % 50}") for i in range(121)] + [(i, "nine", "x") for i in range(9)] + [(1, "ß", "y"), (2, None, "z"), (3, "", None)]
    rows += [(5, "same", "s")] * 40
    docs = spark.createDataFrame([(i, g, t, "a", 1, "b") for i, g, t in rows], "doc_id long, lang string, text string, _id string, _pos int, leaf string")
    leaf = leaf_digest(F.col("doc_id"), F.col("text"))
    got = merkle_manifest(docs.repartition(5), leaf, fanout=fanout, block_nodes=block, carry={"kept": F.col("text")}).withColumn("told", fold_proof(F.col("leaf"), F.col("path"), F.col("turns")))
    want = plain_manifest([(i, g, plain_leaf(i, t)) for i, g, t in rows], fanout)
    key = lambda r: tuple((x is not None, x) for x in r)
    found = got.collect()
    assert sorted([(r["doc_id"], r["group"], r["leaf"], r["subroot"], r["root"], bytes(r["path"]).decode()) for r in found], key=key) == sorted(want, key=key)
    assert all(r["told"] == r["root"] for r in found)
    assert all(r["leaf"] == plain_leaf(r["doc_id"], r["kept"]) for r in found)
    assert sorted(r["place"] for r in found if r["group"] == "hot") == list(range(121))


def test_a_changed_leaf_or_sibling_gives_another_root():
    nodes = np.frombuffer("".join(H(str(i)) for i in range(13)).encode(), np.uint8).reshape(-1, 64)
    levels = levels_of(nodes, 3, None)
    near, there, turns = sibling_rows(levels, 3)
    root = levels[-1][0].tobytes().decode()
    for i in range(13):
        path, turn, leaf = near[i][there[i]].tobytes(), turns[i].tobytes(), nodes[i].tobytes().decode()
        assert fold(leaf, path, turn) == root
        assert fold(H("else"), path, turn) != root
        assert fold(leaf, path[:5] + b"f" + path[6:], turn) != root or path[5:6] == b"f"
    with pytest.raises(ValueError, match="siblings"):
        fold(leaf, path + b"0" * 64, turn)


def test_tampered_rows_of_odd_tables(spark, tmp_path):
    rows = [(i, None if i % 5 == 0 else "x" * (i % 4), "en" if i % 3 else None, None, None if i % 4 == 0 else i) for i in range(60)]
    rows += [(None, None, None, None, None), (9, "long " * 40_000, "en", "s", 2**63 - 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = op11_merkle(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    want = {(r[0], r[2]): r for r in plain_manifest([(i, la, plain_leaf(i, s, la, n, t)) for i, t, la, s, n in rows])}
    for r in got:
        mate = want[r["doc_id"], r["leaf"]]
        assert (r["subroot"], r["root"], r["proof_sha256"]) == (mate[3], mate[4], H(mate[5]))
    counted = {(i, plain_leaf(i, s, la, n, t)): n for i, t, la, s, n in rows}
    for r in got:
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and counted[r["doc_id"], r["leaf"]] is not None
        assert r["verified"] == (not hit) == (r["folded_root"] == r["root"])


def test_manifest_of_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert merkle_manifest(docs, leaf_digest(F.col("doc_id"), F.col("text"))).count() == 0
