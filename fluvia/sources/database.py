"""Databases as a data source of Spark: slices of a key, a cursor, pushed filters, rows fetched by the chunk.

``connect`` is a function that opens a DB-API connection where it is called, so each task has
its own; it takes the name of one of ``shards``.  The driver asks each shard for the
bounds of the key and reads no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import to_arrow_schema

#: Filters that are sent along, and how SQL writes them.
_SENT = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


@dataclass
class _Slice(InputPartition):
    shard: str
    where: str
    values: tuple


def _name(column: str) -> str:
    return '"' + column.replace('"', '""') + '"'


class _Reader(DataSourceReader):
    def __init__(self, connect: Callable[[str], Any], shards: Sequence[str], statement: str, schema: T.StructType, key: str | None, slices: int, cursor: str | None, last: Any, end: Any, chunk: int) -> None:
        self.connect, self.shards, self.statement, self.schema = connect, list(shards), statement, schema
        self.key, self.slices, self.chunk = key, slices, chunk
        self.where, self.values = "1 = 1", ()
        bounds = [(f"{_name(cursor)} {op} ?", v) for op, v in ((">=", last), ("<", end)) if v is not None] if cursor else []
        if bounds:
            # Rows without a cursor are read too.
            self._add(f"(({' and '.join(b for b, _ in bounds)}) or {_name(cursor)} is null)", *[v for _, v in bounds])

    def _add(self, condition: str, *values: Any) -> None:
        self.where, self.values = f"{self.where} and {condition}", (*self.values, *values)

    def partitions(self) -> Sequence[InputPartition]:
        out = []
        for shard in self.shards:
            low = high = None
            if self.key and self.slices > 1:
                connection = self.connect(shard)
                try:
                    found = connection.cursor()
                    found.execute(f"select min({_name(self.key)}), max({_name(self.key)}) from ({self.statement}) q where {self.where}", self.values)
                    low, high = found.fetchone()
                finally:
                    connection.close()
            if low is None:
                out.append(_Slice(shard, self.where, self.values))
                continue
            width = max(1, -(-(high - low + 1) // self.slices))
            for k, start in enumerate(range(low, high + 1, width)):
                # Rows without a key are the first slice's.
                nothing = f" or {_name(self.key)} is null" if k == 0 else ""
                out.append(_Slice(shard, f"{self.where} and (({_name(self.key)} >= ? and {_name(self.key)} < ?){nothing})", (*self.values, start, start + width)))
        return out

    def read(self, partition: _Slice) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        columns = ", ".join(_name(f.name) for f in self.schema)
        connection = self.connect(partition.shard)
        try:
            rows = connection.cursor()
            rows.execute(f"select {columns} from ({self.statement}) q where {partition.where}", partition.values)
            while some := rows.fetchmany(self.chunk):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema, strict=True)], schema=schema)
        finally:
            connection.close()


class _Filtered(_Reader):
    """Sends filters along; Spark refuses such a reader where the setting for it is off."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            kind, column = type(f), getattr(f, "attribute", ())
            if kind in _SENT and len(column) == 1 and isinstance(f.value, (int, float, str)) and not isinstance(f.value, bool):
                self._add(f"{_name(column[0])} {_SENT[kind]} ?", f.value)
            elif kind in (IsNull, IsNotNull) and len(column) == 1:
                self._add(f"{_name(column[0])} is {'not ' if kind is IsNotNull else ''}null")
            else:
                yield f


def scan(
    spark: SparkSession, connect: Callable[[str], Any], shards: Sequence[str], statement: str, schema: str, key: str | None = None, slices: int = 1,
    cursor: str | None = None, last: Any = None, end: Any = None, chunk: int = 1000,
) -> DataFrame:
    """The rows of ``statement`` in every shard, with the columns of ``schema``.

    ``key``: a whole-number column by whose range a shard is read in ``slices`` tasks.  ``cursor``: rows from ``last``
    on and before ``end``.  Filters on columns go to the database where ``spark.sql.python.filterPushdown.enabled`` is set.
    """
    shape = T.StructType.fromDDL(schema)
    name = f"database_{abs(hash((statement, schema, key, cursor, id(connect)))):x}"

    reader_of = _Filtered if spark.conf.get("spark.sql.python.filterPushdown.enabled") == "true" else _Reader

    class Database(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return shape

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return reader_of(connect, shards, statement, schema, key, slices, cursor, last, end, chunk)

    spark.dataSource.register(Database)
    return spark.read.format(name).load()
