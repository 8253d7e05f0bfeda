"""What is looked at in order: scans, samples, pages, listings, batches, and previews within a budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ranks
from .land import LOAD, ROW, STAMPS

#: Rows of a sample or page at most, rows of a batch.
MOST, BATCH = 100, 500


def in_load_order(df: DataFrame) -> DataFrame:
    """Rows by load and row id: a range-partitioned sort."""
    return df.orderBy(LOAD, ROW)


def sampled(df: DataFrame, limit: int = MOST) -> DataFrame:
    """The first rows in load order, without internal columns; never more than ``MOST``."""
    first = in_load_order(df) if {LOAD, ROW} <= set(df.columns) else df
    return first.limit(max(0, min(limit, MOST))).drop(*STAMPS)


def page(items: DataFrame, order: Sequence[str | Column], cursor: str | None = None, limit: int = MOST) -> tuple[DataFrame, str | None]:
    """(rows, next cursor): ``limit`` rows from the cursor on, and the offset behind them as a text; None at the end.

    A sorted limit keeps so many rows in each task; no task sees them all.
    """
    start = int(cursor) if cursor and cursor.isdigit() else 0
    size = max(1, min(limit, MOST))
    # One row more than a page has tells whether there is another page.
    found = items.orderBy(*order).offset(start).limit(size + 1)
    more = found.count() > size
    return found.limit(size), str(start + size) if more else None


def one_level(files: DataFrame, folder: str, contains: str | None = None) -> DataFrame:
    """(kind, name, size) right below ``folder`` of a listing (path, size) of all that lies below it: folders first, then by name.

    ``contains``: a part of the name, whatever its case.  A folder has no size.
    """
    base = folder.split("://")[-1].rstrip("/") + "/"
    at = F.locate(base, F.col("path"))
    below = files.where(at > 0).select(F.call_function("substring", F.col("path"), at + len(base)).alias("rest"), "size")
    inside = F.contains(F.col("rest"), F.lit("/"))
    level = below.select(F.when(inside, "folder").otherwise("file").alias("kind"), F.substring_index("rest", "/", 1).alias("name"), F.when(~inside, F.col("size")).alias("size")).distinct()
    if contains is not None:
        level = level.where(F.contains(F.lower("name"), F.lit(contains.lower())))
    return level.orderBy((F.col("kind") != "folder").cast("int"), "name")


def batched(df: DataFrame, size: int = BATCH) -> DataFrame:
    """``df`` with ``batch_index``: rows in load order, ``size`` to a batch."""
    return ranks.ranked(df, [LOAD, ROW], "_place").withColumn("batch_index", F.expr(f"_place div {int(size)}")).drop("_place")


def within_budget(rows: DataFrame, order: Sequence[str], entry: Column, most_bytes: int, most_rows: int = MOST) -> DataFrame:
    """The first rows whose entries fit the budget, with ``truncated`` on the one that exhausts it, which is the last.

    A preview is ``most_rows`` at most, so the running sum is over a page.
    """
    page_rows = rows.orderBy(*order).limit(most_rows).withColumn("_bytes", F.octet_length(entry).cast("long"))
    upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = page_rows.withColumn("_total", F.sum("_bytes").over(upto))
    return total.where(F.col("_total") - F.col("_bytes") < most_bytes).withColumn("truncated", F.col("_total") >= most_bytes).drop("_bytes", "_total")
