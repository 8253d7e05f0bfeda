"""Queries of grids: each conversation is a sheet with a header, its turns the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import grid
from .registry import query, read


def _sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("sheet"), (F.col("turn") + 2).cast("int").alias("row_number"), F.array("role", F.lit(" "), F.col("turn").cast("string"), F.lit("")).alias("cells"))
    return turns.unionByName(turns.select("sheet").distinct().select("sheet", F.lit(1).alias("row_number"), F.array(F.lit("Who Speaks"), F.lit(""), F.lit("who speaks")).alias("cells")))


@query("SELECT conv_id AS sheet, CAST(turn + 2 AS BIGINT) AS sheet_row_number, nullif(trim(role), '') AS who_speaks, CAST(turn AS VARCHAR) AS who_speaks_2, CAST(NULL AS VARCHAR) AS column_2 FROM conversations")
def grid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.col("record")
    rows = grid.keyed(grid.records(_sheets(spark, sf_dir)), "who_speaks_2", "skip")
    return rows.select("sheet", F.col(grid.ROW_NUMBER).cast("bigint").alias(grid.ROW_NUMBER), *[r[n].alias(n) for n in ("who_speaks", "who_speaks_2", "column_2")])


@query("""
SELECT c.conv_id AS sheet, CAST(c.turn + 2 AS BIGINT) AS row_number, CASE WHEN f.role IS NOT NULL THEN f.role ELSE c.role END AS first_cell, CASE WHEN f.role IS NOT NULL THEN f.role ELSE ' ' END AS second_cell
FROM conversations c LEFT JOIN conversations f ON f.conv_id = c.conv_id AND f.turn = 0 AND c.turn <= 1
""")
def merged_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two cells of each sheet's rows 2 and 3 are merged."""
    sheets = _sheets(spark, sf_dir)
    regions = sheets.where("row_number = 2").select("sheet", F.lit(2).alias("top"), F.lit(1).alias("left"), F.lit(3).alias("bottom"), F.lit(2).alias("right"))
    out = grid.filled(sheets, regions).where("row_number > 1")
    return out.select("sheet", F.col("row_number").cast("bigint").alias("row_number"), F.col("cells")[0].alias("first_cell"), F.col("cells")[1].alias("second_cell"))
