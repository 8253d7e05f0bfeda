"""Exact places in an order, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import tables


def ranked(df: DataFrame, order: Sequence[str], place: str = "place") -> DataFrame:
    """``df`` with ``place``, each row's place from 0 on by the columns of ``order`` (nulls first).

    Rows are dealt by ranges once, sorted, and written with their number, which holds the
    partition and the row's place in it.  The counts of the partitions are taken from
    what is written: dealing the rows again for them would draw other samples, hence
    other ranges, and neither fit the rows.  Rows that are equal in ``order`` have places next to each other.
    """
    spark, path = df.sparkSession, tables.scratch(df.sparkSession, "ranked")
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_n", F.monotonically_increasing_id())
    dealt.write.parquet(path)
    rows = spark.read.schema(dealt.schema).parquet(path).withColumn("_part", F.shiftright("_n", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition, so few enough for every task.
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_count"), F.min("_n").alias("_first"))
    starts = counts.select("_part", (F.coalesce(F.sum("_count").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    return rows.join(F.broadcast(starts), "_part").withColumn(place, F.col("_start") + F.col("_n")).drop("_part", "_n", "_start")
