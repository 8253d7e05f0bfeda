"""Queries of versioned tables, exactly-once projections, writers and database scans."""

from __future__ import annotations

import os
import re
import shutil
import sqlite3
import tempfile
from functools import partial

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import mapping
from ..operators import dispatch, land, project
from ..sources import database, tables, versioned
from .registry import query, read


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
  CASE o_orderstatus WHEN 'F' THEN 'two' WHEN 'P' THEN 'three' ELSE 'one' END AS _load_id, o_orderstatus = 'P' AS _connector_deleted
FROM orders
""")
def versioned_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads merged into buckets: all orders, some anew, some deleted; the second one is landed twice and counts once."""
    root = tables.scratch(spark, "versioned")
    versioned.create(spark, root, ["o_orderkey"], 16)
    orders = _orders(spark, sf_dir)
    again = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    gone = orders.where("o_orderstatus = 'P'").select("o_orderkey", F.lit(True).alias(land.DELETED))
    for load, df in (("one", orders), ("two", again), ("two", orders), ("three", gone)):
        versioned.merge(land.stamped(df, "b1", f"run-{load}", load), root, load, cursor="o_orderdate" if load != "three" else None)
    return versioned.table(spark, root).select("o_orderkey", "o_totalprice", land.LOAD, land.DELETED)


@query("""
SELECT load_id, count(*) AS rows, count(*) FILTER (deleted) AS tombstones, strftime(max(o_orderdate) FILTER (NOT deleted), '%Y-%m-%d') AS high
FROM (SELECT *, false AS deleted, 'one' AS load_id FROM orders UNION ALL SELECT *, o_orderstatus = 'P', 'two' FROM orders WHERE o_orderstatus <> 'O') GROUP BY 1
""")
def load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each load had, as noted in the commit that landed it; nothing is counted again."""
    root = tables.scratch(spark, "ledger")
    versioned.create(spark, root, ["o_orderkey"], 8)
    orders = _orders(spark, sf_dir)
    gone = F.col("o_orderstatus") == "P"
    second = orders.where("o_orderstatus <> 'O'").withColumn(land.DELETED, gone).withColumn("o_orderdate", F.when(~gone, F.col("o_orderdate")))
    for load, df in (("one", orders), ("two", second)):
        versioned.merge(land.stamped(df, "b1", "r1", load), root, load, cursor="o_orderdate")
    return versioned.ledger(spark, root).select("load_id", "rows", "tombstones", F.left("high", F.lit(10)).alias("high"))


_NODES = {"external_id": {"source": "event_id", "cast": "string"}, "type": {"function": "upper", "args": [{"source": "event_type"}]}, "value": {"source": "value"}, "k": {"source": "props", "json_path": "k", "cast": "integer"}}


def _dispatched(spark: SparkSession, sf_dir: str) -> tuple[str, list[dict]]:
    """Events landed and projected load by load: all of them, then errors deleted and clicks without a name, which the target requires."""
    landing, target = tables.scratch(spark, "landing"), tables.scratch(spark, "target")
    versioned.create(spark, landing, ["event_id"], 8)
    versioned.create(spark, target, ["external_id"], 8)
    events = read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    second = events.where("event_type in ('error', 'click', 'view')").withColumn(land.DELETED, F.col("event_type") == "error")
    second = second.withColumn("event_type", F.when(F.col("event_type") != "click", F.col("event_type"))).withColumn("value", F.col("value") * 2)
    told = []
    run = partial(dispatch.dispatched, spark, landing, target, lambda df: mapping.compile_mapping(df, _NODES), ["external_id"], required=["type"], filters=lambda df: mapping.all_of(df, [{"field": "event_id", "op": "gt", "value": 10}]))
    for load, df in (("1", events), ("2", second)):
        versioned.merge(land.stamped(df, "b1", f"r{load}", load), landing, load)
        told.append(run(f"p{load}"))
        # The same again: nothing is outstanding, or the run has committed.
        told.append(run(f"p{load}"))
    return target, told


@query("""
SELECT CAST(event_id AS VARCHAR) AS external_id, upper(event_type) AS type, CASE WHEN event_type = 'view' THEN value * 2 ELSE value END AS value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events WHERE event_id > 10 AND event_type <> 'error'
""")
def projection_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target after two loads, each projected twice."""
    return versioned.table(spark, _dispatched(spark, sf_dir)[0])


@query("""
WITH e AS (SELECT event_type, event_id > 10 AS kept FROM events), s AS (SELECT * FROM e WHERE event_type IN ('error', 'click', 'view'))
SELECT 'p1' AS run_id, 1 AS loads, count(*) AS seen, count(*) FILTER (NOT kept) AS filtered, 0 AS skipped, count(*) FILTER (kept) AS written, 0 AS deleted FROM e
UNION ALL SELECT 'p2', 1, count(*), count(*) FILTER (NOT kept), count(*) FILTER (kept AND event_type = 'click'), count(*) FILTER (kept AND event_type = 'view'), count(*) FILTER (kept AND event_type = 'error') FROM s
""")
def projection_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of those projections with their counters: one row each, however often they ran."""
    runs = versioned.ledger(spark, _dispatched(spark, sf_dir)[0])
    of = lambda name: F.col("counts")[name].alias(name)
    return runs.select("run_id", F.size("taken").alias("loads"), of("seen"), of("filtered"), of("skipped"), (F.col("rows") - F.col("tombstones")).alias("written"), F.col("tombstones").alias("deleted"))


def _refuse(batch: list[dict], context: dispatch.Context) -> dispatch.Result:
    """A host that takes no order of a customer whose number ends in 7."""
    left = [r for r in batch if r["operation"] == "upsert" and r["values"]["o_custkey"] % 10 == 7]
    up = sum(r["operation"] == "upsert" for r in batch)
    return dispatch.Result(written=up - len(left), skipped=len(left), warnings=[f"{context.batch_index}: {len(left)}"] if left else [])


@query("""
WITH o AS (SELECT *, o_orderstatus = 'P' AS gone, (row_number() OVER (ORDER BY o_orderstatus = 'P', o_orderkey) - 1) // 500 AS batch_index FROM orders)
SELECT CAST(batch_index AS BIGINT) AS batch_index, count(*) FILTER (NOT gone AND o_custkey % 10 <> 7) AS written, count(*) FILTER (gone) AS deleted, count(*) FILTER (NOT gone AND o_custkey % 10 = 7) AS skipped
FROM o GROUP BY 1
""")
def writer_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders given to a host's writer, 500 to a batch, deletions last; what it says of each batch."""
    landed = land.stamped(_orders(spark, sf_dir).withColumn(land.DELETED, F.col("o_orderstatus") == "P"), "b1", "r1", "1")
    cells = mapping.compile_mapping(landed, {c: {"source": c} for c in ("o_orderkey", "o_custkey", "o_totalprice")})
    records = project.collapsed(project.projected(landed, cells, ["o_orderkey"]), ["o_orderkey"])
    return dispatch.delivered(records, _refuse, ["o_orderkey"], "run-1").select("batch_index", "written", "deleted", "skipped")


def _sqlite(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE (o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 2 YEAR FROM orders) OR o_orderdate IS NULL) AND o_custkey > 5
""")
def scan_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in databases in the shared folder, one to a task, read from a cursor on in slices of their key."""
    path = tables.scratch(spark, "databases")
    folder = re.sub("^file:/+", "/", path)

    def fill(frames):
        with tempfile.TemporaryDirectory() as own:
            at = f"{own}/orders.db"
            connection = sqlite3.connect(at)
            connection.execute("create table orders (o_orderkey integer, o_custkey integer, o_totalprice real, o_orderdate text)")
            n = 0
            for frame in frames:
                rows = frame.astype(object).where(frame.notna(), None)
                connection.executemany("insert into orders values (?, ?, ?, ?)", rows.itertuples(index=False))
                n += len(frame)
            connection.commit()
            connection.close()
            # A file takes its final name only when it is whole; an attempt that is repeated makes the same one.
            name, own_name = f"{folder}/{TaskContext.get().partitionId()}.db", f"{folder}/.{TaskContext.get().taskAttemptId()}"
            os.makedirs(folder, exist_ok=True)
            shutil.copyfile(at, own_name)
            os.replace(own_name, name)
            yield pd.DataFrame({"shard": [name], "n": [n]})

    orders = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"))
    last = orders.agg(F.date_format(F.add_months(F.max(F.col("o_orderdate").cast("timestamp")), -24), "yyyy-MM-dd HH:mm:ss")).first()[0]
    shards = [r.shard for r in orders.mapInPandas(fill, "shard string, n long").collect()]
    found = database.scan(spark, _sqlite, shards, "select * from orders", "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate string", "o_orderkey", 3, "o_orderdate", last)
    return found.where("o_custkey > 5").select("o_orderkey", "o_custkey", "o_totalprice")
