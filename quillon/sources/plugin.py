"""Shards behind one format, whatever holds them: a Python data source with back ends that can be named.

    register(spark)
    spark.read.format("quillon_shards").option("path", folder).option("back_end", "wav").option("shards", "0-4,7").load()
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from importlib import import_module
from pathlib import PurePosixPath
from typing import Protocol

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..schemas import SOURCE
from .shards import file_system, parse_shard_spec, shard_number

#: Rows that a back end gives at once.
BATCH = 256


class BackEnd(Protocol):
    """What a back end is: made with the folder and the options, in the driver to plan and in each task to read."""

    def __init__(self, folder: str, options: dict[str, str]): ...

    def shards(self) -> list[int]:
        """The numbers of the shards there are."""
        ...

    def tables(self, shard: int, want: pa.Schema) -> Iterator[pa.Table]:
        """The rows of a shard in their order, in parts. Columns that the shard lacks may be left out."""
        ...


class ParquetShards:
    """shard-NNNNN.parquet in a folder; only the columns that are asked for are read."""

    def __init__(self, folder: str, options: dict[str, str]):
        self.fs, self.folder = file_system(folder)

    def _names(self, suffix: str) -> dict[int, str]:
        from pyarrow.fs import FileSelector

        found = self.fs.get_file_info(FileSelector(self.folder, allow_not_found=True))
        numbers = {shard_number(f.base_name): f.path for f in found if f.base_name.startswith("shard-") and f.base_name.endswith(suffix)}
        return {n: path for n, path in numbers.items() if n is not None}

    def shards(self) -> list[int]:
        return sorted(self._names(".parquet"))

    def tables(self, shard: int, want: pa.Schema) -> Iterator[pa.Table]:
        from pyarrow.parquet import ParquetFile

        with self.fs.open_input_file(self._names(".parquet")[shard]) as opened:
            read = ParquetFile(opened)
            names = [c for c in want.names if c in read.schema_arrow.names]
            for batch in read.iter_batches(BATCH, columns=names):
                yield pa.Table.from_batches([batch]).append_column("_rows", pa.nulls(batch.num_rows))


class WavShards(ParquetShards):
    """Folders shard-NNNNN with WAV files and meta.jsonl: a line a clip, whose "audio" names the file. Lines give the order."""

    def shards(self) -> list[int]:
        return sorted(self._names(""))

    def tables(self, shard: int, want: pa.Schema) -> Iterator[pa.Table]:
        folder = self._names("")[shard]
        with self.fs.open_input_stream(f"{folder}/meta.jsonl") as opened:
            lines = [json.loads(line) for line in opened.read().decode().split("\n") if line.strip()]
        for at in range(0, len(lines), BATCH):
            rows = lines[at : at + BATCH]
            if "audio" in want.names:
                rows = [r | {"audio": self._clip(folder, r.get("audio"))} for r in rows]
            cols = {f.name: self._column([r.get(f.name) for r in rows], f.type) for f in want if f.name not in ("shard", "pos")}
            yield pa.table(cols | {"_rows": pa.nulls(len(rows))})

    def _clip(self, folder: str, name: str | None) -> dict | None:
        if name is None:
            return None
        if PurePosixPath(name).name != name:
            raise ValueError(f"the name of a clip must be a file of its shard: {name}")
        with self.fs.open_input_stream(f"{folder}/{name}") as opened:
            return {"bytes": opened.read(), "path": name}

    def _column(self, values: list, kind: pa.DataType) -> pa.Array:
        return pa.array(values).cast(kind) if pa.types.is_timestamp(kind) else pa.array(values, kind)


#: Back ends by short name; others are named as module:Class.
BACK_ENDS = {"parquet": ParquetShards, "wav": WavShards}


def back_end(name: str) -> type[BackEnd]:
    if name in BACK_ENDS:
        return BACK_ENDS[name]
    module, colon, kind = name.partition(":")
    if not colon:
        raise ValueError(f"a back end is one of {', '.join(BACK_ENDS)}, or module:Class; not {name}")
    return getattr(import_module(module), kind)


class ShardPartition(InputPartition):
    def __init__(self, shard: int):
        super().__init__(shard)
        self.shard = shard


def _test_of(f: Filter):
    """The test that a filter on shard makes of its number, or None where it is about something else."""
    if getattr(f, "attribute", None) != ("shard",):
        return None
    tests = {
        EqualTo: lambda n: n == f.value, EqualNullSafe: lambda n: n == f.value, In: lambda n: n in f.value, GreaterThan: lambda n: n > f.value,
        GreaterThanOrEqual: lambda n: n >= f.value, LessThan: lambda n: n < f.value, LessThanOrEqual: lambda n: n <= f.value,
    }
    return tests.get(type(f))


class ShardReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        if "path" not in options:
            raise ValueError("the folder of the shards is the option path")
        self.schema, self.options, self.tests = schema, dict(options), []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            test = _test_of(f)
            if test is None:
                yield f
            else:
                self.tests.append(test)

    def _back_end(self) -> BackEnd:
        return back_end(self.options.get("back_end", "parquet"))(self.options["path"], self.options)

    def partitions(self) -> list[ShardPartition]:
        there = self._back_end().shards()
        if self.options.get("shards"):
            wanted = set(parse_shard_spec(self.options["shards"]))
            there = [n for n in there if n in wanted]
        return [ShardPartition(n) for n in there if all(test(n) for test in self.tests)]

    def read(self, partition: ShardPartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark reads where no shard is planned
            return
        want, first = to_arrow_schema(self.schema), 0
        for rows in self._back_end().tables(partition.shard, want):
            n = rows.num_rows
            own = {"shard": pa.array([partition.shard] * n), "pos": pa.array(range(first, first + n))}
            first += n
            cols = [own[f.name] if f.name in own else rows[f.name] if f.name in rows.column_names else pa.nulls(n, f.type) for f in want]
            fitted = [c if c.type == f.type else c.cast(f.type) for c, f in zip(cols, want, strict=True)]
            yield from pa.table(fitted, schema=want).combine_chunks().to_batches()


class ShardSource(DataSource):
    """Rows of SOURCE with shard and pos, or of the schema that is given, null where a shard lacks a column; a partition is a shard.

    Options: path (the folder), back_end (parquet, wav, or module:Class), shards (a specification such as "0-4,7"; all if it is absent). Shards that the specification
    leaves out are not planned, nor those that a filter on shard does. A schema of few columns reads those only. Folders
    are paths or URIs that pyarrow.fs opens. A folder that is not there, or empty, has no rows.
    """

    @classmethod
    def name(cls) -> str:
        return "quillon_shards"

    def schema(self) -> str:
        return f"{SOURCE}, shard int, pos long"

    def reader(self, schema: StructType) -> ShardReader:
        return ShardReader(schema, self.options)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, and lets filters reach sources of this kind: without that setting Spark refuses a source that takes them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ShardSource)
