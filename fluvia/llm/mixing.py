"""Operator 5: mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of ``epochs`` times the
corpus over what it has (both in characters).  Each document inverts the Poisson
distribution with that mean at a uniform number hashed from its id and the seed,
is exploded by its count, and the copies are dealt out and ordered by a hash of
id, copy and seed, which is a global shuffle.  A mean beyond ``CHUNK`` is the sum
of equal parts with a number of their own each, so no mean underflows.

Null sources form a source of their own; null texts have no characters; a source
without characters gets the rate of an average one (``epochs``).  Rows that
repeat a doc_id get equal counts.  A null doc_id hashes as the word null.  Texts of
any length are measured whole and pass unchanged.  An empty table gives an empty
result.  Further columns of any name pass; the two that are added take names that
the table hasn't, or it is refused.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SEED, EPOCHS, TEMPERATURE, CHUNK = "mix-1", 1.0, 0.5, 32.0
#: Rates of so many sources are broadcast at most; with more, the join is left to Spark.
BROADCAST_SOURCES = 100_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) hashed from texts."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def rates(df: DataFrame, weights: Mapping[str | None, float] | None = None, epochs: float = EPOCHS, temperature: float = TEMPERATURE) -> DataFrame:
    """(source, rate): the mean repetitions.  Without ``weights`` a share is in proportion to size ** temperature."""
    sizes = df.groupBy("source").agg(F.sum(F.length(common.text_of()).cast("long")).alias("size"))
    if weights is None:
        share = F.when(F.col("size") > 0, F.pow(F.col("size").cast("double"), F.lit(temperature))).otherwise(0.0)
    else:
        share = F.lit(0.0)
        for source, weight in weights.items():
            share = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(weight))).otherwise(share)
    sizes = common.staged(sizes.withColumn("share", share), "sizes")
    # The totals of a few numbers for each source: one row.
    total = sizes.agg(F.sum("size").alias("all_size"), F.sum("share").alias("all_share")).first()
    rate = F.lit(epochs) * F.col("share") / F.lit(float(total.all_share or 1.0)) * F.lit(float(total.all_size or 0)) / F.col("size")
    return sizes.select("source", F.when(F.col("size") > 0, rate).otherwise(F.lit(epochs)).alias("rate"))


def poisson(rate: Column, key: Column, seed: str) -> Column:
    """The count of a key: how many steps of the cumulated distribution lie at or below its number."""
    parts = F.greatest(F.lit(1), F.ceil(rate / CHUNK).cast("int"))
    mean = rate / parts

    def one(part: Column) -> Column:
        u = uniform(key, F.lit(seed), part.cast("string"))
        start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.lit(0).alias("n"))

        def step(at: Column, k: Column) -> Column:
            p = at["p"] * mean / k
            return F.when(at["c"] > u, at).otherwise(F.struct(p.alias("p"), (at["c"] + p).alias("c"), k.cast("int").alias("n")))

        most = F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int")
        return F.aggregate(F.sequence(F.lit(1), most), start, step, lambda at: at["n"])

    return F.aggregate(F.transform(F.sequence(F.lit(1), parts), one), F.lit(0), lambda a, b: a + b)


def mixed(df: DataFrame, weights: Mapping[str | None, float] | None = None, epochs: float = EPOCHS, temperature: float = TEMPERATURE, seed: str = SEED, number: str = "copy", key: str = "shuffle_key") -> DataFrame:
    """The rows of ``df`` (doc_id, text, source, ...), repeated, with the columns ``number`` (from 1) and ``key``."""
    if taken := {number, key} & set(df.columns):
        raise ValueError(f"the table has columns named {sorted(taken)}: give other names for number and key")
    rate = common.staged(rates(df.select("source", "text"), weights, epochs, temperature), "rates")
    if rate.count() <= BROADCAST_SOURCES:
        rate = F.broadcast(rate)
    rows = df.select(common.row_of(df).alias("row"), F.col("source").alias("of"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"))
    counted = rows.join(rate, F.col("of").eqNullSafe(F.col("source"))).select("row", "id", poisson(F.col("rate"), F.col("id"), seed).alias("n"))
    copies = counted.where("n > 0").select("row", "id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("k"))
    keyed = copies.withColumn("place", F.md5(F.concat_ws(":", "id", F.lit(seed), F.lit("copy"), F.col("k").cast("string")).cast("binary")))
    dealt = keyed.repartition("place").sortWithinPartitions("place")
    return dealt.select("row.*", F.col("k").alias(number), F.col("place").alias(key))
