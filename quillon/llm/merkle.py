"""Merkle manifest of a dataset: digest matrices by aligned blocks, a proof for each row, and its check."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ._common import saved, table
from .textbytes import spans

#: Bytes of a digest as lower-case hex.
DIGEST = 64
#: A block holds the largest power of the fan-out up to this many nodes.
BLOCK_NODES = 4096
_HEX = np.frombuffer("".join(f"{b:02x}" for b in range(256)).encode(), np.uint8).reshape(256, 2)


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 over the fields, each its UTF-8 byte count, ":" and its text, or "-" where it is null."""
    told = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in (f.cast("string") for f in fields)]
    return F.sha2(F.concat(*told), 256)


def digest_matrix(digests: pa.Array) -> np.ndarray:
    """Hex digests as one contiguous matrix of n rows of 64 bytes."""
    return spans(digests)[0].reshape(-1, DIGEST)


def level_up(nodes: np.ndarray, fanout: int) -> np.ndarray:
    """The digests of the runs of fanout nodes; the last run may hold fewer."""
    full = len(nodes) // fanout * fanout
    rows = list(nodes[:full].reshape(-1, fanout * DIGEST))
    if full < len(nodes):
        rows.append(nodes[full:].reshape(-1))
    return _HEX[np.frombuffer(b"".join(sha256(r).digest() for r in rows), np.uint8)].reshape(-1, DIGEST)


def levels_of(nodes: np.ndarray, fanout: int, height: int | None) -> list[np.ndarray]:
    """The matrices of height levels above the nodes, nodes first; without a height, up to the level that has one node."""
    out = [nodes]
    while (len(out[-1]) > 1) if height is None else (len(out) <= height):
        out.append(level_up(out[-1], fanout))
    return out


def sibling_rows(levels: list[np.ndarray], fanout: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(siblings, there, turns) of all nodes of the lowest level, up to the highest.

    Node i stands at i // fanout**k on level k; its run starts at that number rounded down to the fan-out, and the others of the run are its
    siblings: (nodes, levels * (fanout - 1), 64), with there false where a run has fewer. turns holds for each level the node's place in its run and the run's size.
    """
    at, other = np.arange(len(levels[0])), np.arange(fanout - 1)
    found, there, turns = [], [], []
    for nodes in levels[:-1]:
        place, first = at % fanout, at - at % fanout
        near = first[:, None] + other + (other >= place[:, None])
        there.append(near < len(nodes))
        found.append(nodes[np.minimum(near, len(nodes) - 1)])
        turns.append(np.stack((place, np.minimum(fanout, len(nodes) - first)), axis=1))
        at = at // fanout
    if not found:
        none = len(levels[0])
        return np.zeros((none, 0, DIGEST), np.uint8), np.zeros((none, 0), bool), np.zeros((none, 0), np.uint8)
    return np.concatenate(found, axis=1), np.concatenate(there, axis=1), np.concatenate(turns, axis=1).astype(np.uint8)


def fold(leaf: str, path: bytes, turns: bytes) -> str:
    """The root that a leaf and its proof give: path holds the siblings in order, turns (place, size) of each run."""
    node, at = leaf.encode(), 0
    for place, size in zip(turns[::2], turns[1::2], strict=True):
        here, after = at + place * DIGEST, at + (size - 1) * DIGEST
        node, at = sha256(path[at:here] + node + path[here:after]).hexdigest().encode(), after
    if at != len(path):
        raise ValueError("a proof with more siblings than its turns name")
    return node.decode()


def _folds(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([None if None in row else fold(*row) for row in zip(*(c.to_pylist() for c in batch), strict=True)], pa.string())


def fold_proof(leaf: Column, path: Column, turns: Column) -> Column:
    """The root recomputed from a leaf's digest and its proof alone; null where one of them is null."""
    return F.arrow_udf(_folds, "string")(leaf, path, turns)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds _part, _run (of a group within the sorted partition), _nth (in the run) and _end (of the run)."""
    from pyspark import TaskContext

    part, run, nth, last, held = TaskContext.get().partitionId(), -1, 0, None, None

    def told(batch, runs, nths, ends):
        cols = [pa.array(np.full(len(runs), part, np.int32)), pa.array(runs), pa.array(nths), pa.array(ends)]
        return pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, "_part", "_run", "_nth", "_end"])

    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column("_group").to_numpy(zero_copy_only=False)
        new = np.concatenate(([last is None or group[0] != last], group[1:] != group[:-1]))
        if held is not None:
            held[3][-1] = new[0]
            yield told(*held)
        place = np.arange(len(group))
        start = np.maximum.accumulate(np.where(new, place, -nth))
        runs, nths = run + np.cumsum(new), place - start
        held = (batch, runs, nths, np.concatenate((new[1:], [True])))
        run, nth, last = int(runs[-1]), int(nths[-1]) + 1, group[-1]
    if held is not None:
        yield told(*held)


def _numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """rows with _pos, the place in the _group from 0 in that order, and _last, whether no other of the group comes after.

    One range-partitioned sort; a group may lie in many partitions. What a partition must know of those before it, how many rows of its first group they
    have, is one number a partition: that table, as long as the sort has partitions, is added up in the driver and broadcast.
    """
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    placed = saved(rows.sort("_group", *order).mapInArrow(_number, f"{kept}, _part int, _run long, _nth long, _end boolean"), "zstd")
    parts = placed.groupBy("_part").agg(
        F.min_by("_group", "_run").alias("first"), F.count_if(F.col("_run") == 0).alias("n_first"), F.max(F.struct("_run", "_nth", "_group")).alias("end")
    )
    known, before, table_of = parts.orderBy("_part").collect(), ("", 0), []  # before: group and rows so far at the end of the part before
    for k, p in enumerate(known):
        offset = before[1] if k and before[0] == p["first"] else 0
        goes_on = k + 1 < len(known) and known[k + 1]["first"] == p["end"]["_group"]
        table_of.append((p["_part"], offset, p["end"]["_run"], goes_on))
        before = (p["end"]["_group"], p["end"]["_nth"] + 1 + (offset if p["end"]["_run"] == 0 else 0))
    spark = rows.sparkSession
    offsets = F.broadcast(spark.createDataFrame(table_of, "_part int, _offset long, _final long, _on boolean"))
    return placed.join(offsets, "_part").select(
        *rows.columns, (F.col("_nth") + F.when(F.col("_run") == 0, F.col("_offset")).otherwise(0)).alias("_pos"),
        (F.col("_end") & ~(F.col("_on") & (F.col("_run") == F.col("_final")))).alias("_last"),
    )


def _shape(rows: pa.Table, fanout: int, height: int) -> tuple[pa.Table, list[np.ndarray], bool, bool]:
    """(rows of a block by place, its levels, whether the group ends here, whether the block is the whole group)."""
    rows = rows.sort_by("_pos").combine_chunks()
    last = bool(np.any(rows["_last"].to_numpy()))
    whole = last and rows["_pos"][0].as_py() < fanout**height
    return rows, levels_of(digest_matrix(rows["_digest"].combine_chunks()), fanout, None if whole else height), last, whole


def _lift(fanout: int, height: int):
    """A block's top node, with its place among the blocks of its group."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        _, levels, last, whole = _shape(rows, fanout, height)
        return pa.table({"_group": [key[0].as_py()], "_pos": [key[1].as_py()], "_digest": [levels[-1][0].tobytes().decode()], "_last": [last], "_whole": [whole]})

    return run


def _prove(fanout: int, height: int, kept: list[str]):
    """The nodes of a block with their proofs: own siblings, then those of the block's top node."""

    def run(key: tuple, rows: pa.Table, above: pa.Table) -> pa.Table:
        rows, levels, _, _ = _shape(rows, fanout, height)
        near, there, turns = sibling_rows(levels, fanout)
        path, turn, root, subroot = (above[c][0].as_py() for c in ("_path", "_turns", "_root", "_subroot"))
        paths = [(n.tobytes() if all_there else n[t].tobytes()) + path for n, t, all_there in zip(near, there, there.all(axis=1), strict=True)]
        n = rows.num_rows
        own = {
            "_path": pa.array(paths, pa.binary()), "_turns": pa.array([t.tobytes() + turn for t in turns], pa.binary()),
            "_root": pa.array([root] * n, pa.string()), "_subroot": pa.array([subroot if subroot is not None else None] * n, pa.string()),
        }
        return pa.table({c: rows[c] for c in kept} | own)

    return run


_PROOF = "_path binary, _turns binary, _root string, _subroot string"


def _block(height: int, fanout: int) -> Column:
    return F.floor(F.col("_pos") / fanout**height).cast("long").alias("_block")


def _rounds(nodes: DataFrame, fanout: int, height: int) -> tuple[list[DataFrame], DataFrame]:
    """(nodes of each round, tops): blocks give their top nodes to the next round until each group is one block. tops: _group, _digest, _round."""
    rounds, tops = [nodes], []
    while True:
        lifted = saved(
            rounds[-1].groupBy("_group", _block(height, fanout))
            .applyInArrow(_lift(fanout, height), "_group string, _pos long, _digest string, _last boolean, _whole boolean"), "zstd"
        )
        tops.append(lifted.filter("_whole").select("_group", "_digest", F.lit(len(rounds) - 1).alias("_round")))
        left = lifted.filter("not _whole").drop("_whole")
        if left.isEmpty():
            return rounds, reduce(DataFrame.unionByName, tops)
        rounds.append(left)


def _proven(rounds: list[DataFrame], tops: DataFrame, fanout: int, height: int) -> DataFrame:
    """The nodes of the first round with their proofs. tops: _group, _round and the proof of the group's own root."""
    above = tops.select("_group", F.lit(0).cast("long").alias("_block"), "_round", *[f.split()[0] for f in _PROOF.split(", ")])
    down = None
    for k in range(len(rounds) - 1, -1, -1):
        here = above.filter(F.col("_round") == k).drop("_round")
        if down is not None:
            here = here.unionByName(down.withColumnRenamed("_pos", "_block"))
        kept = [c for c in rounds[k].columns if c not in ("_last",)] if k == 0 else ["_group", "_pos"]
        schema = StructType([rounds[k].schema[c] for c in kept] + StructType.fromDDL(_PROOF).fields)
        nodes = rounds[k].withColumn("_block", _block(height, fanout))
        down = nodes.groupBy("_group", "_block").cogroup(here.groupBy("_group", "_block")).applyInArrow(_prove(fanout, height, kept), schema)
    return down


def merkle_manifest(
    docs: DataFrame, leaf: Column, id_col: str = "doc_id", group_col: str = "lang", carry: dict[str, Column] | None = None, fanout: int = 2, block_nodes: int = BLOCK_NODES
) -> DataFrame:
    """One row per document: id, group, place, leaf, subroot, root, path, turns, and the columns of carry.

    leaf is a Column with a hex SHA-256 of the row (leaf_digest). In each group (null is a group) leaves stand by id, null ids first, equal ids by
    leaf. Runs of fanout nodes become the digest of their hex texts laid end to end, level by level, until one is left: the subroot (a lone leaf itself).
    Subroots by group, null first, then by UTF-8 bytes, give the root in the same way. path holds the siblings of the row from its leaf to the
    root, 64 bytes each, and turns two bytes a level, the place in the run and the run's size: fold_proof() needs no more.

    Texts are read once and never shuffled: a sort moves ids and digests, with as many rows of a group as there are. Blocks of at most block_nodes
    nodes, aligned to the fan-out, are hashed as one matrix by one task; their top nodes are the next round's nodes, so that a group of n rows takes
    log(n) / log(block_nodes) rounds, and no task holds more than a block. Proofs come down the same way, each block with the proof of its top node.
    Each round is saved, so a lost executor costs its own blocks only.

    Rows that repeat have leaves of their own. Null columns count as the leaf says. Other columns of the input are not read. An empty table
    gives an empty result. carry adds columns by name, of names other than the result's.
    """
    if not 2 <= fanout <= 255 or block_nodes < fanout:
        raise ValueError("a fan-out from 2 to 255, and blocks of one run at least")
    height = 1
    while fanout ** (height + 1) <= block_nodes:
        height += 1
    group = F.col(group_col).cast("string")
    given = {f"_c{i}": c for i, c in enumerate((carry or {}).values())}
    rows = saved(docs.select(
        F.coalesce(F.concat(F.lit("v"), group), F.lit("")).alias("_group"), F.col(id_col).alias("_id"), leaf.alias("_digest"), *[c.alias(k) for k, c in given.items()]
    ), "zstd")
    # rows that agree in all are told apart by where they are saved, so that a range can end between them
    nodes = _numbered(rows.withColumn("_row", F.monotonically_increasing_id()), [F.col("_id").asc_nulls_first(), F.col("_digest"), F.col("_row")]).drop("_row")
    rounds, tops = _rounds(nodes, fanout, height)
    tops = saved(tops)
    named = tops.select(F.lit("").alias("_group"), F.col("_group").alias("_of"), "_digest", "_round")
    upper, peak = _rounds(_numbered(named, [F.col("_of")]), fanout, height)
    none = F.lit(b"").cast("binary")
    roots = peak.select("_group", "_round", none.alias("_path"), none.alias("_turns"), F.col("_digest").alias("_root"), F.lit(None).cast("string").alias("_subroot"))
    led = saved(_proven(upper, roots, fanout, height).select(F.col("_of").alias("_group"), "_round", "_path", "_turns", "_root", F.col("_digest").alias("_subroot")))
    proven = _proven(rounds, led, fanout, height)
    return proven.select(
        F.col("_id").alias(id_col), F.when(F.col("_group") != "", F.substring("_group", 2, 1 << 30)).alias("group"), F.col("_pos").alias("place"), F.col("_digest").alias("leaf"),
        F.col("_subroot").alias("subroot"), F.col("_root").alias("root"), F.col("_path").alias("path"), F.col("_turns").alias("turns"),
        *[F.col(k).alias(name) for k, name in zip(given, carry or {}, strict=True)],
    )


def op11_merkle(spark, sf_dir: str) -> DataFrame:
    """The manifest of documents by language; where 7 divides the crc32 of the id, the check gets a leaf with one more character counted."""
    docs = table(spark, sf_dir, "documents")
    fields = lambda n: [F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text")]
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    kept = merkle_manifest(docs, leaf_digest(*fields(F.col("n_chars"))), carry={"tampered": F.when(hit, leaf_digest(*fields(more)))})
    told = fold_proof(F.coalesce("tampered", "leaf"), F.col("path"), F.col("turns"))
    return kept.select("doc_id", "leaf", "subroot", "root", F.sha2("path", 256).alias("proof_sha256"), told.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )


def _sql_field(c: str) -> str:
    return f"coalesce(strlen(cast({c} as varchar)) || ':' || {c}, '-')"


def _sql_leaf(n: str) -> str:
    return "sha256(" + " || ".join(_sql_field(c) for c in ("doc_id", "source", "lang", n, "text")) + ")"


OP11_SQL = f"""
with recursive crc as (
  select *, xor(4294967295::ubigint, list_reduce(list_prepend(4294967295::ubigint, list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii(substr(cast(doc_id as varchar), i, 1))::ubigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)::ubigint[]), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end))) as crc
  from documents),
leaves as (
  select doc_id, coalesce('v' || lang, '') as g, {_sql_leaf("n_chars")} as leaf,
    case when crc % 7 = 0 and n_chars is not null then {_sql_leaf("(n_chars + 1)")} end as tampered,
    row_number() over (partition by lang order by doc_id) - 1 as i, count(*) over (partition by lang) as n
  from crc),
up as (
  select g, 0 as lv, i, leaf as h, n from leaves
  union all
  select g, lv + 1, i // 2, sha256(string_agg(h, '' order by i)), any_value((n + 1) // 2) from up where n > 1 group by g, lv, i // 2),
tops as (select g, h as subroot, row_number() over (order by g) - 1 as i, count(*) over () as n from up where n = 1),
top as (
  select 0 as lv, i, subroot as h, n from tops
  union all
  select lv + 1, i // 2, sha256(string_agg(h, '' order by i)), any_value((n + 1) // 2) from top where n > 1 group by lv, i // 2),
steps as (
  select l.doc_id, u.lv as step, (l.i >> u.lv) & 1 as side, s.h as sibling
  from leaves l join (select distinct g, lv from up where n > 1) u on u.g = l.g
  left join up s on s.g = l.g and s.lv = u.lv and s.i = xor(l.i >> u.lv, 1)
  union all
  select l.doc_id, 100 + t.lv, (p.i >> t.lv) & 1, s.h
  from leaves l join tops p on p.g = l.g cross join (select distinct lv from top where n > 1) t
  left join top s on s.lv = t.lv and s.i = xor(p.i >> t.lv, 1)),
ordered as (select *, row_number() over (partition by doc_id order by step) as k from steps),
proofs as (select doc_id, coalesce(string_agg(sibling, '' order by k), '') as path, count(*) as n from ordered group by doc_id),
folded as (
  select doc_id, 0 as k, coalesce(tampered, leaf) as h from leaves
  union all
  select f.doc_id, f.k + 1, sha256(case when o.sibling is null then f.h when o.side = 1 then o.sibling || f.h else f.h || o.sibling end)
  from folded f join ordered o on o.doc_id = f.doc_id and o.k = f.k + 1)
select l.doc_id, l.leaf, p.subroot, t.h as root, sha256(coalesce(f.path, '')) as proof_sha256, d.h as folded_root, d.h = t.h as verified
from leaves l join tops p on p.g = l.g cross join (select h from top where n = 1) t
left join proofs f on f.doc_id = l.doc_id join folded d on d.doc_id = l.doc_id and d.k = coalesce(f.n, 0)
"""
