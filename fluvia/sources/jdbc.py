"""Databases by JDBC: one query or table, from a cursor on, in slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def selected(query: str | None = None, table: str | None = None, schema: str | None = None, cursor: str | None = None, last: str | None = None, end: str | None = None) -> str:
    """The statement that is sent.  ``last`` and ``end`` are SQL literals; rows without a cursor are read too."""
    if (query is None) == (table is None):
        raise ValueError("give a query or a table")
    base = query or f"select * from {f'{schema}.' if schema else ''}{table}"
    if cursor is None or (last is None and end is None):
        return base
    bounds = [f"{cursor} >= {last}"] * (last is not None) + [f"{cursor} < {end}"] * (end is not None)
    return f"select * from ({base}) q where ({' and '.join(bounds)}) or {cursor} is null"


def scan(spark: SparkSession, url: str, statement: str, chunk_size: int = 1000, slices: tuple[str, int, int, int] | None = None, properties: dict[str, str] | None = None) -> DataFrame:
    """Exactly the columns of ``statement``.  ``slices``: a numeric column, its bounds and how many reads share the work."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=f"({statement}) t", fetchsize=chunk_size, **(properties or {}))
    if slices:
        column, low, high, n = slices
        reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=n)
    return reader.load()
