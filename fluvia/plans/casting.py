"""Queries of casts, target fields, paths and schema evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import casts, mapping
from ..operators import land
from .registry import query, read


@query("""
SELECT o_orderkey, strftime(o_orderdate + INTERVAL (o_orderkey % 1440) MINUTE - INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') || '+00:00' AS at,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00+00:00' END AS day
FROM orders
""")
def cast_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as written in one zone, by a format, and ISO dates of which some don't exist."""
    orders = read(spark, sf_dir, "orders")
    at = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("o_orderkey") % 1440).cast("int"))
    written = F.date_format(at, "d/M/yy h:mm a")
    df = orders.select("o_orderkey", written.alias("w"), F.when(F.col("o_orderstatus") == "P", "2023-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("d"))
    cells = mapping.compile_mapping(df, {"at": {"source": "w", "cast": "datetime", "format": "%d/%m/%y %I:%M %p", "timezone": "Asia/Kolkata"}, "day": {"source": "d", "cast": "datetime"}})
    return df.select("o_orderkey", *[casts.as_text(c.value, c.kind).alias(k) for k, c in cells.items()])


@query("""
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice * pow(10, l_linenumber * 3 - 9) AS VARCHAR) AS price FROM lineitem
""")
def cast_text_of_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers from very small to very large ones as texts."""
    df = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * F.pow(F.lit(10.0), F.col("l_linenumber") * 3 - 9)).alias("price"))
    cell = mapping.compile_node(df, {"source": "price", "cast": "string"})
    return df.select("l_orderkey", "l_linenumber", cell.value.alias("price"))


@query("""
SELECT p_partkey, CASE WHEN length(p_name) <= 12 THEN p_name END AS name, length(p_name) > 12 AS too_long,
  CASE WHEN p_retailprice = floor(p_retailprice) THEN CAST(p_retailprice AS BIGINT) END AS price, p_retailprice <> floor(p_retailprice) AS no_whole
FROM part
""")
def target_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values as a target's fields take them: a text of at most twelve characters, a decimal into a whole number."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", F.col("p_retailprice").cast("decimal(12,2)").alias("p"))
    cells = mapping.coerced(mapping.compile_mapping(part, {"name": {"source": "p_name"}, "price": {"source": "p"}}), {"name": {"type": "string", "max_length": 12}, "price": {"type": "integer"}})
    return part.select("p_partkey", cells["name"].value.alias("name"), cells["name"].error.isNotNull().alias("too_long"), cells["price"].value.alias("price"), cells["price"].error.isNotNull().alias("no_whole"))


@query("SELECT p_partkey, p_type AS last, p_brand AS second, p_size AS size, NULL AS inner FROM part")
def json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys, indices from either end, and a text that is JSON itself and isn't gone into."""
    inner = F.to_json(F.struct(F.lit(1).alias("a")))
    raw = F.to_json(F.struct(F.array("p_name", "p_brand", "p_type").alias("x"), F.struct(F.col("p_size").alias("0")).alias("y"), inner.alias("z")))
    df = read(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"))
    paths = {"last": "x.-1", "second": "x.1", "size": "y.0", "inner": "z.a"}
    cells = mapping.compile_mapping(df, {k: {"source": "raw", "json_path": p} for k, p in paths.items()} | {"size": {"source": "raw", "json_path": "y.0", "cast": "integer"}})
    return df.select("p_partkey", *[c.value.alias(k) for k, c in cells.items()])


@query("""
SELECT p_partkey, CASE WHEN v = floor(v) THEN CAST(v AS BIGINT) END AS v, CASE WHEN v <> floor(v) THEN v END AS v__v_double
FROM (SELECT p_partkey, p_retailprice AS v FROM part UNION ALL SELECT p_partkey, p_size FROM part)
""")
def evolve_whole_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices come into a column of whole numbers: those that aren't whole go beside it."""
    part = read(spark, sf_dir, "part")
    old, new = land.evolved(part.select("p_partkey", F.col("p_size").cast("bigint").alias("v")), part.select("p_partkey", F.col("p_retailprice").alias("v")))
    return old.unionByName(new)
