"""Word differences for display, and stable pseudo-random ranks."""

from __future__ import annotations

import difflib
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_CELLS = "array<struct<op:string,token:string>>"
_CELL_TYPE = pa.list_(pa.struct([("op", pa.string()), ("token", pa.string())]))


def word_diff(base: str, other: str) -> list[dict[str, str]]:
    """equal, ins, del and sub cells by matching blocks. A replaced run shows the new words as sub, then the old ones in excess as del."""
    old, new = base.split(), other.split()
    out: list[dict[str, str]] = []
    i = j = 0
    for block in difflib.SequenceMatcher(None, old, new, autojunk=False).get_matching_blocks():
        gone, come = old[i : block.a], new[j : block.b]
        name = "sub" if gone else "ins"
        out += [{"op": name, "token": w} for w in come]
        out += [{"op": "del", "token": w} for w in gone[len(come) :]]
        i, j = block.a + block.size, block.b + block.size
        out += [{"op": "equal", "token": w} for w in new[block.b : j]]
    return out


def _diffs(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for base, other in batches:
        yield pa.array([word_diff(a or "", b or "") for a, b in zip(base.to_pylist(), other.to_pylist(), strict=True)], _CELL_TYPE)


def diff_ops(base: Column, other: Column) -> Column:
    """array<struct<op, token>> that turns base into other; null texts are blank."""
    return F.arrow_udf(_diffs, _CELLS)(base, other)


def _ranks(ids: pa.Array) -> pa.Array:
    return pa.array([None if i is None else hashlib.blake2b(i.encode(), digest_size=8).digest() for i in ids.to_pylist()], pa.binary())


def stable_rank(key: Column) -> Column:
    """Eight bytes of BLAKE2b of the key as text; bytes sort as the unsigned number does. Null for null."""
    return F.arrow_udf(_ranks, "binary")(key.cast("string"))


def md5_rank(key: Column) -> Column:
    """A rank that other engines have as well."""
    return F.md5(key.cast("string"))
