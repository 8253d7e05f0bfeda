"""Queries of streams: tables are dealt into files, which a stream reads a few at a time until it has them all."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import mapping
from ..operators import land
from ..sources import tables
from ..streaming import deliveries, keyed, landing
from .registry import query, read

#: Event time that state is kept for: longer than the tables last, so that what is late is not lost.
WHOLE = "3650 days"


#: Micro-batches that a table comes in.
BATCHES = 2


def _stream(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The table as files, one for each task or partition at least, read in ``BATCHES`` triggers: a trigger has as many tasks as it has files."""
    path = tables.scratch(spark, name)
    files = max(BATCHES, spark.sparkContext.defaultParallelism, df.rdd.getNumPartitions())
    df.repartition(files).write.parquet(f"{path}/in")
    return landing.files(spark, f"{path}/in", df.schema, -(-files // BATCHES)), path


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as deliveries; errors have neither id nor body."""
    body = F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type"))
    return read(spark, sf_dir, "events").select(F.col("user_id").alias("subscription"), F.lit("").alias("delivery_id"), body.alias("body"), F.col("ts").cast("timestamp").alias("ts"), "event_id")


#: Time slices that a table of deliveries comes in, each by a run of its own.
SLICES = 3


def _accepted(spark: SparkSession, df: DataFrame, rule: Callable[[DataFrame], keyed.Kept], name: str) -> DataFrame:
    """What ``rule`` gives of deliveries (``ts``) that come slice by slice, the stream stopped and started again between.

    A row later than all, of no subscription, comes last: it moves the watermark past all others.
    """
    path = tables.scratch(spark, name)
    bounds = df.select(F.unix_micros("ts").alias("at")).approxQuantile("at", [k / SLICES for k in range(1, SLICES)], 0.01)
    bounds = [float("-inf"), *bounds, float("inf")]
    out = None
    for k, (low, high) in enumerate(zip(bounds, bounds[1:])):
        at = F.unix_micros("ts").cast("double")
        part = df.where((at >= low) & (at < high))
        if k == SLICES - 1:
            # Null times are in no slice: no rule has a place for them.
            last = df.agg(F.max("ts").alias("ts")).select((F.col("ts") + F.expr("interval 2 days")).alias("ts"))
            part = part.unionByName(last, allowMissingColumns=True)
        part.write.mode("append").parquet(f"{path}/in")
        out = landing.drained(rule(landing.files(spark, f"{path}/in", df.schema, 1_000_000)), path)
    return out


def _quick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as deliveries on a clock sixty times as fast: a month in half a day."""
    at = F.timestamp_micros(F.expr("unix_micros(cast(ts as timestamp)) div 60"))
    return read(spark, sf_dir, "events").where("user_id is not null").select(F.col("user_id").alias("subscription"), F.lit("").alias("delivery_id"), F.col("event_type").alias("body"), at.alias("ts"), F.col("event_id").alias("id"))


_QUICK = "d AS (SELECT user_id, event_type, event_id, CAST(event_id AS VARCHAR) AS id, epoch_us(ts) // 60 AS t FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL)"


@query(f"""
WITH RECURSIVE {_QUICK},
taken AS (
  SELECT user_id, event_type, min(t) AS t FROM d GROUP BY 1, 2
  UNION ALL SELECT d.user_id, d.event_type, min(d.t) FROM taken k JOIN d ON d.user_id = k.user_id AND d.event_type = k.event_type AND d.t >= k.t + {keyed.DEDUPE_S * 1_000_000} GROUP BY 1, 2)
SELECT d.user_id, d.event_id, k.t IS NOT NULL AND row_number() OVER (PARTITION BY d.user_id, d.event_type, d.t ORDER BY d.id) = 1 AS accepted
FROM d LEFT JOIN taken k ON k.user_id = d.user_id AND k.event_type = d.event_type AND k.t = d.t
WHERE d.event_type <> ''
UNION ALL SELECT user_id, event_id, true FROM d WHERE event_type IS NULL OR event_type = ''
""")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A body of a subscription is accepted, then not again for ten minutes, then again."""
    out = _accepted(spark, _quick(spark, sf_dir), lambda s: keyed.once(deliveries.fingerprinted(s)), "dedupe")
    return out.where("subscription is not null").select(F.col("subscription").alias("user_id"), F.col("id").cast("long").alias("event_id"), "accepted")


@query(f"""
WITH {_QUICK}
SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type, t // 60000000 ORDER BY t, id) <= 3 AS accepted FROM d WHERE event_type IS NOT NULL
""")
def stream_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three deliveries of a kind in each minute are accepted."""
    kinds = _quick(spark, sf_dir).where("body is not null").withColumn("subscription", F.col("body"))
    out = _accepted(spark, kinds, lambda s: keyed.within_limit(s, most=3), "limit")
    return out.where("subscription is not null").select(F.col("subscription").alias("event_type"), F.col("id").cast("long").alias("event_id"), "accepted")


@query(f"""
WITH RECURSIVE {_QUICK},
opened AS (
  SELECT user_id, min(t) AS t FROM d GROUP BY 1
  UNION ALL SELECT d.user_id, min(d.t) FROM opened o JOIN d ON d.user_id = o.user_id AND d.t >= o.t + {keyed.WINDOW_S * 1_000_000} GROUP BY 1)
SELECT o.user_id, o.t AS opened, o.t + {keyed.WINDOW_S * 1_000_000} AS runs_at, (SELECT count(*) FROM d WHERE d.user_id = o.user_id AND d.t >= o.t AND d.t < o.t + {keyed.WINDOW_S * 1_000_000}) > 1 AS dirty
FROM opened o
""")
def stream_debounce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A burst of a subscription is one run, and one more if anything came after the first delivery."""
    out = _accepted(spark, _quick(spark, sf_dir), lambda s: keyed.debounced(s, "subscription"), "debounce")
    return out.where("key is not null").select(F.col("key").alias("user_id"), F.unix_micros("opened").alias("opened"), F.unix_micros("runs_at").alias("runs_at"), "dirty")


@query("""
SELECT DISTINCT user_id AS subscription, event_type AS body FROM events WHERE event_type <> 'error' AND event_type <> ''
UNION ALL SELECT user_id, coalesce(nullif(event_type, 'error'), '') FROM events WHERE event_type IN ('error', '') OR event_type IS NULL
""")
def stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A body is accepted once for as long as the table lasts; deliveries without id and body all are."""
    # An id of some kind tells every event from the row that comes last.
    every = _deliveries(spark, sf_dir).withColumn("id", F.coalesce(F.col("event_id").cast("string"), F.lit(""))).drop("event_id")
    out = _accepted(spark, every, lambda s: keyed.once(deliveries.fingerprinted(s), seconds=3650 * 86_400), "once")
    bodies = deliveries.fingerprinted(every).where("fingerprint is not null").select("fingerprint", "body").distinct()
    return out.where("accepted and id is not null").join(bodies, "fingerprint", "left").select("subscription", F.coalesce("body", F.lit("")).alias("body"))


@query("SELECT user_id AS subscription, date_trunc('minute', ts) AS minute, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1, 2")
def stream_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts as they grow: the last one of each window is kept."""
    stream, path = _stream(spark, _deliveries(spark, sf_dir), "rate")
    grown = landing.drained(deliveries.per_minute(stream, WHOLE), path, mode="update")
    return grown.groupBy("subscription", F.col("window.start").cast("timestamp_ntz").alias("minute")).agg(F.max("n").alias("n"))


@query("""
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS k FROM events) WHERE k = 1 OR user_id IS NULL
""")
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest event of each user, whichever micro-batch brought it."""
    events = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    stream, path = _stream(spark, events, "landing")
    order = [F.col("ts"), F.col("event_id")]
    rows = landing.drained(stream, path, lambda b: land.stamped(land.newest(b, ["user_id"], order), "b1", "r1", "000001"))
    return land.newest(rows, ["user_id"], order).select("user_id", "event_id", "event_type")


@query("SELECT event_type, count(*) AS rows, count(*) AS ids, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without their ids, many of them equal, appended batch by batch and compacted: every row stays, with an id of its own."""
    stream, path = _stream(spark, read(spark, sf_dir, "events").select("user_id", "event_type"), "append")
    rows = landing.appended(stream, path, "b1", "r1", buckets=4, most=2)
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(land.ROW).alias("ids"), F.count_distinct("user_id").alias("users"))


@query("SELECT CAST(event_id AS VARCHAR) AS external_id, upper(event_type) AS type, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS operation FROM events")
def stream_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").select("event_id", "event_type", (F.col("event_type") == "error").alias(land.DELETED))
    stream, path = _stream(spark, land.stamped(events, "b1", "r1", "000001"), "projection")
    nodes = {"external_id": {"source": "event_id", "cast": "string"}, "type": {"function": "upper", "args": [{"source": "event_type"}]}, "seen": {"source": "event_type"}}
    out = landing.projected(stream, path, lambda b: mapping.compile_mapping(b, nodes), ["external_id"])
    return out.select("values.external_id", F.when(F.col("operation") == "delete", "ERROR").otherwise(F.col("values.type")).alias("type"), "operation")


@query("SELECT CAST(event_id AS VARCHAR) AS external_id, upper(event_type) AS type, value FROM events WHERE event_type <> 'error'")
def stream_projection_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed and projected batch by batch, each load once; a second run of the stream finds nothing to do."""
    events = read(spark, sf_dir, "events").select("event_id", "event_type", "value", (F.col("event_type") == "error").alias(land.DELETED))
    stream, path = _stream(spark, events, "projected-once")
    nodes = {"external_id": {"source": "event_id", "cast": "string"}, "type": {"function": "upper", "args": [{"source": "event_type"}]}, "value": {"source": "value"}}
    run = lambda: landing.projected_once(stream, path, ["event_id"], [F.col("event_id")], "b1", lambda df: mapping.compile_mapping(df, nodes), ["external_id"], ["type"])
    run()
    return run()
