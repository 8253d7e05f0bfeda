"""Reshaping: unpivot, header names, grids of cells."""

from __future__ import annotations

import fnmatch
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    """Columns whose name matches a case-sensitive glob, in order."""
    return [c for c in df.columns if fnmatch.fnmatchcase(c, pattern)]


def unpivoted(df: DataFrame, stages: Sequence[str], keep: Sequence[str], name_to: str = "stage", value_to: str = "value", drop_empty: bool = True) -> DataFrame:
    """A row for each stage column.  Blank text is empty; a row whose stages are all empty still gives each of them."""
    if not stages:
        raise ValueError("no stage column found")
    value = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    pairs = F.array(*[F.struct(F.lit(c).alias("n"), F.when(value(c).isNotNull(), F.col(c).cast("string")).alias("v")) for c in stages])
    if drop_empty:
        full = F.filter(pairs, lambda p: p["v"].isNotNull())
        pairs = F.when(F.size(full) > 0, full).otherwise(pairs)
    return df.select(*keep, F.explode(pairs).alias("_p")).select(*keep, F.col("_p.n").alias(name_to), F.col("_p.v").alias(value_to))


def snake(name: Column) -> Column:
    """Lower snake case of a name."""
    split = F.regexp_replace(F.regexp_replace(F.trim(name), r"([A-Z]+)([A-Z][a-z])", "$1_$2"), r"([a-z0-9])([A-Z])", "$1_$2")
    return F.lower(F.regexp_replace(F.regexp_replace(split, r"[^A-Za-z0-9_]+", "_"), r"_+", "_"))


def grid_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """Lines of a text as numbered rows of trimmed cells; blank rows go, the number counts all lines."""
    rows = df.select(key, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("pos", "line"))
    cells = F.transform(F.split("line", " "), lambda c: F.nullif(F.trim(c), F.lit("")))
    return rows.select(key, (F.col("pos") + 1).alias("row_number"), cells.alias("cells")).where(F.exists("cells", lambda c: c.isNotNull()))
