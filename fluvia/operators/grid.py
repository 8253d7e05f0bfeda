"""Grids of cells (sheet, row_number, cells) as records.

Rows number from 1, the header counted.  A sheet without a header row, or with
that row alone, gives no records; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shape import snake

# The name of the row's number among the columns, and the provenance columns.
ROW_NUMBER = "sheet_row_number"
PROVENANCE = ("_file_id", "_file_name", "_file_path", "_file_modified_at", "_sheet_name", "_row_number")


def blank(cell: Column) -> Column:
    return F.coalesce(F.trim(cell), F.lit("")) == ""


def trimmed(cells: Column) -> Column:
    """Cells without the blank ones at the end."""
    last = F.aggregate(F.transform(cells, lambda c, i: F.when(~blank(c), i + 1).otherwise(0)), F.lit(0), lambda a, b: F.greatest(a, b))
    return F.slice(cells, F.lit(1), last)


def header_names(cells: Column) -> Column:
    """Snake-cased names: ``column_N`` for blanks, a suffix where a name is taken."""
    plain = F.transform(cells, lambda c, i: F.when(blank(c) | (snake(c) == ""), F.concat(F.lit("column_"), (i + 1).cast("string"))).otherwise(snake(c)))

    def add(names: Column, name: Column) -> Column:
        tries = F.transform(F.sequence(F.lit(1), F.size(names) + 2), lambda k: F.when(k == 1, name).otherwise(F.concat(name, F.lit("_"), k.cast("string"))))
        free = F.filter(tries, lambda t: ~F.array_contains(names, t) & (t != ROW_NUMBER))
        return F.array_append(names, F.get(free, 0))

    return F.aggregate(plain, F.array().cast("array<string>"), add)


def filled(grid: DataFrame, regions: DataFrame) -> DataFrame:
    """Every cell of a merged region (sheet, top, left, bottom, right; from 1) gets its top-left value.

    Regions are dealt out to their rows, so the join is on sheet and row.
    """
    corner = grid.select("sheet", F.col("row_number").alias("top"), F.col("cells").alias("_top"))
    valued = regions.join(corner, ["sheet", "top"]).select("sheet", "top", "bottom", F.struct("left", "right", F.get("_top", F.col("left") - 1).alias("value")).alias("r"))
    rows = valued.select("sheet", F.explode(F.sequence("top", "bottom")).alias("row_number"), "r").groupBy("sheet", "row_number").agg(F.collect_list("r").alias("_regions"))
    over = lambda i: F.get(F.filter("_regions", lambda r: (r["left"] <= i + 1) & (r["right"] >= i + 1)), 0)
    cells = F.transform("cells", lambda c, i: F.when(F.col("_regions").isNotNull() & over(i).isNotNull(), over(i)["value"]).otherwise(c))
    return grid.join(rows, ["sheet", "row_number"], "left").select("sheet", "row_number", cells.alias("cells"))


def records(grid: DataFrame, header_row: int | None = 1, skip_rows: int = 0, trim: bool = True) -> DataFrame:
    """(sheet, sheet_row_number, record): a map from the header's names to texts, as wide as the sheet's widest row.

    Blank cells and those beyond a short row are null, blank rows go.  Without a header
    row (None) columns are numbered.  ``skip_rows``: rows after the header that are left out.
    """
    body = grid.where(F.exists("cells", lambda c: ~blank(c)))
    width = body.groupBy("sheet").agg(F.max(F.size(trimmed(F.col("cells")))).alias("_width"), *([F.max_by("cells", F.col("row_number") == header_row).alias("_head"), F.bool_or(F.col("row_number") == header_row).alias("_has")] if header_row else []))
    padded = lambda c: F.transform(F.sequence(F.lit(1), F.col("_width")), lambda i: F.get(c, i - 1))
    if header_row:
        width = width.where("_has").select("sheet", "_width", header_names(padded(F.col("_head"))).alias("_names"))
    else:
        width = width.select("sheet", "_width", F.transform(F.sequence(F.lit(1), F.col("_width")), lambda i: F.concat(F.lit("column_"), i.cast("string"))).alias("_names"))
    value = lambda c: F.when(~blank(c), F.trim(c) if trim else c)
    cells = F.transform(padded(F.col("cells")), value)
    rows = body.where(F.col("row_number") > (header_row or 0) + skip_rows).join(width, "sheet")
    return rows.select("sheet", F.col("row_number").alias(ROW_NUMBER), F.map_from_arrays("_names", cells).alias("record"))


def with_provenance(rows: DataFrame, file_id: Column, name: Column, path: Column, modified_at: Column) -> DataFrame:
    """Where each row comes from, written last: these columns win over those of the sheet."""
    values = (file_id, name, path, modified_at, F.col("sheet"), F.col(ROW_NUMBER))
    return rows.withColumns(dict(zip(PROVENANCE, values, strict=True)))


def keyed(rows: DataFrame, key: str, missing: str = "error", shown: int = 20) -> DataFrame:
    """Rows whose record has the key; ``missing`` is skip, or error, which names the first rows without it."""
    has = F.col("record")[key].isNotNull()
    if missing == "error":
        bad = rows.where(~has).select("sheet", ROW_NUMBER).orderBy("sheet", ROW_NUMBER).limit(shown).collect()
        if bad:
            raise ValueError(f"no {key!r} in " + ", ".join(f"{r[0]} row {r[1]}" for r in bad))
    return rows.where(has)


def keyless(rows: DataFrame, key: str, shown: int = 20) -> DataFrame:
    """(sheet, n, first): how many rows of each sheet have no key, and the numbers of the first of them; what a skip leaves out."""
    part = rows.where(F.col("record")[key].isNull()).groupBy("sheet", F.spark_partition_id().alias("_p"))
    first = lambda c: F.slice(F.sort_array(c), 1, shown)
    # Each partition's list is cut before they meet.
    some = part.agg(F.count(F.lit(1)).alias("n"), first(F.collect_list(ROW_NUMBER)).alias("first"))
    return some.groupBy("sheet").agg(F.sum("n").alias("n"), first(F.flatten(F.collect_list("first"))).alias("first"))


def disposition(key: Sequence[str] | str | None) -> str:
    """A keyed grid is merged, one without a key replaced."""
    return "merge" if key else "replace"
