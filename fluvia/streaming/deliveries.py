"""What tells deliveries apart, and how many there are; ``keyed`` accepts them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fingerprinted(df: DataFrame, delivery_id: Column | None = None) -> DataFrame:
    """The delivery's id, else the hash of its body; a delivery with neither has none and is never a repeat.

    ``delivery_id``: where a provider's deliveries hold their id; the column of that name otherwise.
    """
    given = F.col("delivery_id") if delivery_id is None else delivery_id
    body = F.when(F.length("body") > 0, F.concat(F.lit("b:"), F.sha2("body", 256)))
    return df.withColumn("fingerprint", F.coalesce(F.when(F.length(given) > 0, F.concat(F.lit("d:"), F.sha2(given, 256))), body))


def parsed(df: DataFrame, delivery_id: Column | None = None, external_ids: Column | None = None) -> DataFrame:
    """``df`` with a delivery's ``fingerprint`` and the ``external_ids`` that it mentions, each once; a provider's parser is these two columns.

    A delivery that mentions nothing has an empty list.  Without a parser the body alone tells deliveries apart.
    """
    told = F.lit(None).cast("array<string>") if external_ids is None else external_ids.cast("array<string>")
    none = F.array().cast("array<string>")
    return fingerprinted(df, F.lit(None).cast("string") if delivery_id is None else delivery_id).withColumn("external_ids", F.array_compact(F.array_distinct(F.coalesce(told, none))))


def per_minute(df: DataFrame, within: str = "1 minute") -> DataFrame:
    """Deliveries of each subscription and minute."""
    return df.withWatermark("ts", within).groupBy("subscription", F.window("ts", "1 minute")).agg(F.count(F.lit(1)).alias("n"))
