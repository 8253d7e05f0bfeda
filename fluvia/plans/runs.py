"""Queries of loads, tenants, batches, pages, previews, contents and provenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import grid, land, ledger, pages
from ..sources import content
from .registry import query, read


@query("""
SELECT 'b1' AS _connector_binding_id, o_orderkey, o_totalprice, o_orderstatus = 'P' AS _connector_deleted FROM orders
UNION ALL SELECT 'b2', o_orderkey, o_totalprice, false FROM orders WHERE o_orderstatus = 'F'
""")
def tenant_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tenants with equal ids in one table: a load of one replaces no row of the other."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", (F.col("o_orderstatus") == "P").alias(land.DELETED), "o_orderstatus")
    first = land.stamped(orders.drop("o_orderstatus"), "b1", "r1", "000001")
    other = land.stamped(orders.where("o_orderstatus = 'F'").drop("o_orderstatus", land.DELETED), "b2", "r2", "000002")
    return land.merged(first, other, ["o_orderkey"]).select(land.BINDING, "o_orderkey", "o_totalprice", land.DELETED)


def _loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger of orders as loads: their day, their state."""
    status = F.when(F.col("o_orderstatus") == "F", "succeeded").when(F.col("o_orderstatus") == "P", "failed").otherwise("pending")
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("load_id"), status.alias("status"), F.col("o_orderdate").cast("timestamp").alias("created_at"), "o_orderpriority")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS load_id FROM orders
WHERE o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 1 YEAR FROM orders) AND o_orderstatus <> 'F'
""")
def pending_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads of the last year that no run has taken; failed runs hold nothing."""
    loads = _loads(spark, sf_dir)
    runs = loads.where("status <> 'pending'").select("status", "load_id")
    newest = loads.agg(F.max("created_at")).first()[0]
    return ledger.outstanding(loads, runs, F.add_months(F.lit(newest), -12).cast("timestamp") if newest else None)


@query("SELECT CAST(l_orderkey AS VARCHAR) AS load_id FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F'")
def claimed_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    mine = read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").cast("string").alias("load_id"))
    return ledger.claimed(mine, _loads(spark, sf_dir).where("status = 'succeeded'"))


@query("""
SELECT 'orders' AS resource, o_orderpriority AS load_id, count(*) AS rows FROM orders GROUP BY 2
UNION ALL SELECT 'lineitem', l_returnflag, count(*) FROM lineitem GROUP BY 2
""")
def load_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda table, column: read(spark, sf_dir, table).select(F.col(column).alias(land.LOAD))
    return ledger.row_counts({"orders": of("orders", "o_orderpriority"), "lineitem": of("lineitem", "l_returnflag")})


@query("""
SELECT o_orderpriority, CASE o_orderstatus WHEN 'F' THEN 'succeeded' WHEN 'P' THEN 'failed' ELSE 'pending' END AS status, count(*) AS runs, strftime(max(o_orderdate), '%Y-%m-%d') AS last_at
FROM orders GROUP BY 1, 2
""")
def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.rolled_up(_loads(spark, sf_dir), ["o_orderpriority"]).withColumn("last_at", F.date_format("last_at", "yyyy-MM-dd"))


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_mktsegment <> 'BUILDING' OR c_nationkey >= 5 OR c_nationkey IS NULL")
def reset_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursors of one binding's resources are forgotten, all others stay."""
    states = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("binding"), F.col("c_nationkey").cast("string").alias("resource"))
    return ledger.reset(states, "BUILDING", [str(k) for k in range(5)]).select("c_custkey", "c_nationkey")


@query("""
SELECT c_custkey, CAST((row_number() OVER (ORDER BY c_custkey) - 1) // ((SELECT count(*) FROM customer) // 3 + 1) AS BIGINT) AS run FROM customer
""")
def backfill_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing taken in three runs, each going on behind the key that the one before parked."""
    customer, parts = read(spark, sf_dir, "customer").select("c_custkey"), []
    most, state = customer.count() // 3 + 1, {"parked": None, "watermark": None}
    while not parts or state["parked"] is not None:
        page, state = ledger.backfilled(customer, "c_custkey", state["parked"], most, "w1")
        parts.append(page.withColumn("run", F.lit(len(parts)).cast("long")))
    return reduce(DataFrame.unionAll, parts)


@query("""
SELECT event_id, CAST((row_number() OVER (ORDER BY event_type, printf('%012d', event_id)) - 1) // 500 AS BIGINT) AS batch_index FROM events
""")
def batch_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").select("event_id", F.col("event_type").alias(land.LOAD), F.lpad(F.col("event_id").cast("string"), 12, "0").alias(land.ROW))
    return pages.batched(events).select("event_id", F.col("batch_index").cast("long").alias("batch_index"))


@query("""
SELECT o_orderkey, total >= 2000 AS truncated FROM (
  SELECT o_orderkey, n, sum(n) OVER (ORDER BY o_orderkey) AS total FROM (SELECT o_orderkey, length(o_orderpriority || o_orderkey) AS n FROM orders ORDER BY o_orderkey LIMIT 100))
WHERE total - n < 2000
""")
def preview_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A preview: the first rows, no more than 100, until 2,000 bytes are shown."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return pages.within_budget(orders, ["o_orderkey"], F.concat("o_orderpriority", F.col("o_orderkey").cast("string")), 2000).select("o_orderkey", "truncated")


@query("SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 50 OFFSET 25")
def offset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page behind a cursor of a sorted listing."""
    return pages.page(read(spark, sf_dir, "part").select("p_partkey", "p_name"), ["p_name", "p_partkey"], "25", 50)[0]


@query("""
WITH f AS (SELECT n_name || CASE WHEN c_acctbal < 0 THEN '/' || c_name ELSE '' END AS rest, CAST(c_custkey AS BIGINT) AS size FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT DISTINCT CASE WHEN contains(rest, '/') THEN 'folder' ELSE 'file' END AS kind, split_part(rest, '/', 1) AS name, CASE WHEN NOT contains(rest, '/') THEN size END AS size
FROM f WHERE contains(lower(split_part(rest, '/', 1)), '1')
""")
def list_one_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders and files right below a folder, by a part of their name."""
    customer, nation = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    path = F.concat(F.lit("s3a://bucket/top/"), "n_name", F.when(F.col("c_acctbal") < 0, F.concat(F.lit("/"), "c_name")).otherwise(""))
    files = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(path.alias("path"), F.col("c_custkey").cast("long").alias("size"))
    return pages.one_level(files, "s3a://bucket/top", "1")


@query("""
SELECT page_id, octet_length(encode(coalesce(html, ''))) AS length, CASE WHEN octet_length(encode(coalesce(html, ''))) <= 3000 THEN 'ok' ELSE 'too_large' END AS state,
  CASE WHEN octet_length(encode(coalesce(html, ''))) <= 3000 THEN md5(coalesce(html, '')) END AS content
FROM pages WHERE contains(url, '/en/')
""")
def fetch_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents of landed pages (those of one language), up to a ceiling; others are asked for in vain."""
    every = read(spark, sf_dir, "pages").withColumn("html", F.coalesce("html", F.lit("")))
    contents = every.select("page_id", F.octet_length("html").cast("long").alias("length"), F.col("html").alias("content"))
    landed = every.where(F.contains(F.col("url"), F.lit("/en/"))).select("page_id")
    got = content.fetched(contents, landed, every.select("page_id"), ["page_id"], 3000)
    return got.select("page_id", "length", "state", F.md5(F.col("content").cast("binary")).alias("content"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O' OR o_orderkey IS NULL")
def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a listing has that was not seen with the same tag: pending ones are new, fulfilled ones have changed."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("string").alias("tag"))
    seen = orders.where("o_orderstatus <> 'P'").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "old").otherwise(F.col("tag")).alias("tag"))
    return content.changed(orders, seen, ["o_orderkey"], "tag").select("o_orderkey")


@query("""
SELECT 'f-' || c_mktsegment AS _file_id, c_mktsegment || '.xlsx' AS _file_name, c_mktsegment AS _sheet_name, CAST(c_custkey + 1 AS BIGINT) AS _row_number, c_name AS name FROM customer
""")
def provenance_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as rows of sheets, with where they come from; a column of the sheet that has such a name loses."""
    customer = read(spark, sf_dir, "customer")
    rows = grid.records(customer.select(F.col("c_mktsegment").alias("sheet"), (F.col("c_custkey") + 1).cast("long").alias("row_number"), F.array("c_name").alias("cells")), header_row=None)
    named = rows.select("sheet", grid.ROW_NUMBER, F.col("record")["column_1"].alias("name"), F.lit("mine").alias("_file_id"))
    out = grid.with_provenance(named, F.concat(F.lit("f-"), "sheet"), F.concat("sheet", F.lit(".xlsx")), F.lit("/books"), F.lit(None).cast("timestamp"))
    return out.select("_file_id", "_file_name", "_sheet_name", "_row_number", "name")
