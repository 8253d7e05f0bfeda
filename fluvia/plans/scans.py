"""Queries of scans, listings, sinks and keyed folds."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names, records
from ..operators import feeds, grid, land, project, shape
from ..sources import files, tables, workbook
from .registry import QUERIES, SQL, Query, query, read

_ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _scan(kind: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders, path = read(spark, sf_dir, "orders").select(*_ORDERS), tables.scratch(spark, kind)
        file_type, options = files.FORMATS[kind]
        orders.write.format(file_type).options(**options).save(f"{path}/one")
        ending = {"jsonl": "json"}.get(kind, kind)
        schema = None if kind == "parquet" else "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
        return files.records(spark, f"{path}/**/*.{ending}", kind, schema).select(*_ORDERS)

    return run


for _kind in files.FORMATS:
    QUERIES[f"scan_{_kind}"] = _scan(_kind)
    SQL[f"scan_{_kind}"] = f"SELECT {', '.join(_ORDERS)} FROM orders"


@query("SELECT o_orderpriority AS priority, 1 AS files FROM orders GROUP BY 1")
def list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder for each priority, one file in each; the listing reads no contents."""
    path = tables.scratch(spark, "listing")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).coalesce(1).write.partitionBy("o_orderpriority").parquet(path)
    found = files.listing(spark, f"{path}/**/*.parquet", contains="PART").where("size > 0")
    folder = F.url_decode(F.regexp_replace(F.regexp_extract("path", "o_orderpriority=([^/]*)/", 1), r"\+", "%2B"))
    return found.select(folder.alias("priority")).groupBy("priority").agg(F.count(F.lit(1)).cast("int").alias("files"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_orderstatus = 'P' AS _connector_deleted FROM orders
""")
def sink_append_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, then a merge of changed and deleted orders into the table."""
    orders, table = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), f"landed_{uuid.uuid4().hex}"
    stamp = lambda df, run: land.stamped(df.select("o_orderkey", "o_totalprice", *[c for c in df.columns if c == land.DELETED]), "b1", run, run)
    tables.replace(stamp(orders.where("o_orderstatus = 'O'"), "1"), table)
    tables.append(stamp(orders.where("o_orderstatus <> 'O' or o_orderstatus is null"), "1"), table)
    changed = orders.where("o_orderstatus in ('F', 'P')").withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice")))
    tables.merge(stamp(changed.withColumn(land.DELETED, F.col("o_orderstatus") == "P"), "2"), table, ["o_orderkey"])
    return spark.table(table).select("o_orderkey", "o_totalprice", land.DELETED)


@query("SELECT CAST(c_custkey AS VARCHAR) AS customer_key, c_name AS name, c_mktsegment AS name_2 FROM customer")
def scan_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in workbooks of up to 500 rows, read back by the names of their header."""
    path = tables.scratch(spark, "books")
    customer = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("a"), F.col("c_name").alias("b"), F.col("c_mktsegment").alias("c"))

    def books(frames):
        for frame in frames:
            for at in range(0, len(frame), 500):
                rows = frame.iloc[at : at + 500].astype(object).where(lambda f: f.notna(), None)
                yield pd.DataFrame({"content": [workbook.packed([["Customer Key", "Name", "name"], *rows.values.tolist()])]})

    customer.mapInPandas(books, "content binary").write.parquet(path)
    rows = workbook.from_bytes(spark.read.parquet(path).select(F.sha2("content", 256).alias("path"), F.lit(None).cast("timestamp").alias("modificationTime"), "content"))
    r = F.col("record")
    return grid.records(workbook.grid(rows)).select(r["customer_key"].alias("customer_key"), r["name"].alias("name"), r["name_2"].alias("name_2"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS order_key, strftime(o_orderdate + INTERVAL (o_orderkey % 86400) SECOND, '%Y-%m-%d %H:%M:%S') AS ordered_at FROM orders")
def scan_workbook_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in workbooks whose dates are serial numbers with a style, read back as dates."""
    path = tables.scratch(spark, "dated-books")
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("a"), (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("o_orderkey") % 86400).cast("decimal(18,6)"))).alias("b"))

    def books(frames):
        for frame in frames:
            for at in range(0, len(frame), 1000):
                some = frame.iloc[at : at + 1000]
                rows = [[a, None if pd.isna(b) else b.to_pydatetime()] for a, b in zip(some["a"], some["b"])]
                yield pd.DataFrame({"content": [workbook.packed([["Order Key", "Ordered At"], *rows])]})

    orders.mapInPandas(books, "content binary").write.parquet(path)
    rows = workbook.from_bytes(spark.read.parquet(path).select(F.sha2("content", 256).alias("path"), F.lit(None).cast("timestamp").alias("modificationTime"), "content"))
    r = F.col("record")
    return grid.records(workbook.grid(rows)).select(r["order_key"].alias("order_key"), r["ordered_at"].alias("ordered_at"))


@query("SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role FROM conversations")
def json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as pages of an interface, their turns picked by a selector."""
    pages = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct("conv_id", "turn", "role")).alias("items"))
    raw = pages.select(F.to_json(F.struct(F.struct("items").alias("data"))).alias("raw"))
    return records.page_records(raw, "data.items", "conv_id bigint, turn bigint, role string")


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, p_type AS name, CAST(p_size AS BIGINT) AS messages_total FROM part")
def flatten_mail_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.to_json(F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_type").alias("name"), F.col("p_size").alias("messagesTotal")))
    return records.mail_labels(read(spark, sf_dir, "part").select(raw.alias("raw"))).select("id", "name", "messages_total")


@query("""
SELECT l_orderkey, l_linenumber, 'l_tax' AS stage, l_tax AS value FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT l_orderkey, l_linenumber, s, CASE WHEN s = 'l_tax' THEN l_tax ELSE l_discount END FROM lineitem, (VALUES ('l_discount'), ('l_tax')) v(s)
WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_returnflag = 'R')
""")
def case_keyed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases that come again replace all their stages: returned lines keep one stage of two."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.col("l_discount").cast("string").alias("l_discount"), F.col("l_tax").cast("string").alias("l_tax"))
    case = ["l_orderkey", "l_linenumber"]
    old = shape.unpivoted(lines, ["l_discount", "l_tax"], case)
    new = shape.unpivoted(lines.where("l_returnflag = 'R'"), ["l_tax"], case)
    return land.merged(old, new, case).withColumn("value", F.col("value").cast("double"))


@query("""
SELECT c_custkey, c_nationkey, c_acctbal FROM customer
WHERE c_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey IS NOT NULL) OR c_mktsegment = 'BUILDING'
""")
def scope_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners that are replayed have nothing but the records of the replay."""
    target = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    again = target.where("c_mktsegment = 'BUILDING'").select(F.lit("upsert").alias("operation"), F.struct("c_custkey", "c_nationkey", "c_acctbal").alias("values"))
    return project.replaced(target.drop("c_mktsegment"), again, ["c_nationkey"])


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'gone' WHEN o_orderstatus = 'P' THEN 'new' WHEN o_custkey % 2 = 0 THEN 'changed' ELSE 'same' END AS state FROM orders
""")
def resync_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full scan against what is landed: orders that are new, changed, unchanged, or gone."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.md5(F.concat_ws("|", "o_custkey", "o_totalprice").cast("binary")).alias("tag"), "o_custkey")
    have = orders.where("o_orderstatus <> 'P'").select("o_orderkey", F.when(F.col("o_custkey") % 2 == 0, "old").otherwise(F.col("tag")).alias("tag"))
    return feeds.resynced(have, orders.where("o_orderstatus <> 'F'").select("o_orderkey", "tag"), ["o_orderkey"], "tag").select("o_orderkey", "state")


@query("""
SELECT c_custkey, n_name, n_name || '_2' AS second FROM (SELECT c_custkey, lower(regexp_replace(regexp_replace(n.n_name, '[^A-Za-z0-9_]+', '_', 'g'), '_+', '_', 'g')) AS n_name FROM customer JOIN nation n ON c_nationkey = n_nationkey)
""")
def grid_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").select("n_nationkey", F.lower("n_name").alias("n"))
    got = read(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", grid.header_names(F.array(F.col("n"), F.lit(" "), F.upper("n"))).alias("h"))
    return got.select("c_custkey", F.col("h")[0].alias("n_name"), F.col("h")[2].alias("second"))


@query("""
SELECT page_id, regexp_matches(url, '/[^/?#]+\\.[A-Za-z0-9]+$') AND NOT regexp_matches(url, '\\.[0-9]+$') AS is_file FROM pages
""")
def file_name_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return pages.select("page_id", names.is_file(F.col("url")).alias("is_file"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS literal FROM orders")
def cursor_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    return orders.select("o_orderkey", names.cursor_literal(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+0000"))).alias("literal"))


@query("SELECT o_orderstatus AS reason, count(*) AS n, CAST(least(3, count(*)) AS BIGINT) AS shown FROM orders GROUP BY 1")
def capped_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact counts for each reason, with the first three rows of it."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("reason"), F.col("o_orderkey").alias("row"))
    return project.warnings(orders, "reason", "row", 3).select("reason", "n", F.size("rows").cast("bigint").alias("shown"))
