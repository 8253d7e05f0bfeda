"""Queries of resources landed table by table: names, dispositions, schema changes and grades, purges, parsed deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import land, resources
from ..operators.resources import Resource
from ..sources import tables, versioned
from ..streaming import deliveries
from .registry import query, read


def _root(base: str, resource: str) -> str:
    return resources.root_of(base, "shop", resource, "k1")


def _land(spark: SparkSession, base: str, load: str, declared: dict[str, Resource], key: str = "k1", only: list[str] | None = None) -> None:
    resources.land_source(spark, base, "shop", key, declared, f"binding-{key}", f"run-{load}", load, only, buckets=8)


@query("""
SELECT event_id, user_id, event_type AS event_type, value AS _2nd_value, '{"k":' || event_id || ',"Kind":"' || coalesce(event_type, '') || '"}' AS propsx FROM events
""")
def land_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A resource whose columns are named in other ways, one of them nested: as its table holds it."""
    base = tables.scratch(spark, "names")
    props = F.struct(F.col("event_id").alias("k"), F.coalesce("event_type", F.lit("")).alias("Kind"))
    odd = read(spark, sf_dir, "events").select(F.col("event_id").alias("EventId"), F.col("user_id").alias("user-id"), F.col("event_type").alias("Event__Type"), F.col("value").alias("2nd value"), props.alias("props_"))
    _land(spark, base, "one", {"Events": Resource(odd, ["EventId"]), "left out": Resource(odd, ["EventId"])}, only=["Events"])
    return versioned.table(spark, _root(base, "Events")).select("event_id", "user_id", "event_type", "_2nd_value", "propsx")


@query("""
SELECT 'one' AS load_id, l_returnflag, count(*) AS rows, count(*) AS ids, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY 2
UNION ALL SELECT 'two', l_returnflag, 2 * count(*), 2 * count(*), CAST(2 * sum(CAST(l_quantity AS BIGINT)) AS BIGINT) FROM lineitem WHERE l_returnflag = 'R' GROUP BY 2
""")
def append_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads appended, the second with every row twice and landed twice: equal rows stay, each with its own id, and a load counts once."""
    base = tables.scratch(spark, "append")
    lines = read(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    returned = lines.where("l_returnflag = 'R'")
    for load, df in (("one", lines), ("two", returned.unionAll(returned)), ("two", lines)):
        _land(spark, base, load, {"lines": Resource(df, disposition="append")})
    root, counts = _root(base, "lines"), f"{base}/counts"
    versioned.compact(spark, root, 1)
    versioned.vacuum(spark, root, keep=1, hours=0)
    # Equal ids lie in one bucket: they are told apart there, and what that deals out goes before the next buckets are read.
    for rows in versioned.by_buckets(spark, root):
        told = rows.groupBy(F.col(land.LOAD).alias("load_id"), "l_returnflag").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(land.ROW).alias("ids"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))
        with versioned.swept(spark):
            told.write.mode("append").parquet(counts)
    every = spark.read.schema(told.schema).parquet(counts).groupBy("load_id", "l_returnflag")
    return every.agg(*[F.sum(c).alias(c) for c in ("rows", "ids", "quantity")])


@query("SELECT c_custkey, c_name, 'two' AS load_id FROM customer WHERE c_acctbal < 0")
def replace_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet without a key, read twice: the second reading, with other columns, is all that is left."""
    base = tables.scratch(spark, "replace")
    customer = read(spark, sf_dir, "customer")
    _land(spark, base, "one", {"sheet": resources.of_sheet(customer.select("c_custkey", "c_mktsegment", "c_acctbal"))})
    _land(spark, base, "two", {"sheet": resources.of_sheet(customer.where("c_acctbal < 0").select("c_custkey", "c_name"))})
    return versioned.table(spark, _root(base, "sheet")).select("c_custkey", "c_name", F.col(land.LOAD).alias("load_id"))


def _changing(spark: SparkSession, sf_dir: str) -> str:
    """Events in four loads: as they are; clicks with a note; views whose value is a text; all as in the first."""
    base = tables.scratch(spark, "changing")
    events = read(spark, sf_dir, "events").select("event_id", "value")
    kind = read(spark, sf_dir, "events").select("event_id", "event_type", "value")
    noted = kind.where("event_type = 'click'").select("event_id", "value", F.lit("n").alias("note"))
    texts = kind.where("event_type = 'view'").select("event_id", F.concat(F.lit("v"), F.col("event_id").cast("string")).alias("value"))
    for load, df in (("one", events), ("two", noted), ("three", texts), ("four", events.where("event_id % 2 = 0"))):
        _land(spark, base, load, {"events": Resource(df, ["event_id"])})
    return base


def _told(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema).coalesce(1)


@query("""
WITH e AS (SELECT event_id % 2 = 0 AS again, event_type = 'click' AS clicked, event_type = 'view' AS viewed, value FROM events)
SELECT 'events' AS resource, 'event_id' AS name, 'bigint' AS type, NULL::VARCHAR AS variant_of, count(*) AS n FROM e
UNION ALL SELECT 'events', 'value', 'double', NULL, count(*) FILTER (value IS NOT NULL AND (again OR viewed IS NOT TRUE)) FROM e
UNION ALL SELECT 'events', 'note', 'string', NULL, count(*) FILTER (clicked AND NOT again) FROM e
UNION ALL SELECT 'events', 'value__v_string', 'string', 'value', count(*) FILTER (viewed AND NOT again) FROM e
""")
def landing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of a landed resource after its source changed, with how many values each holds."""
    base = _changing(spark, sf_dir)
    schema = resources.landed_schema(spark, base, "shop", "k1", ["events", "never landed"])
    columns = schema["resources"]["events"]["columns"]
    counts = versioned.table(spark, _root(base, "events")).agg(*[F.count(c["name"]).alias(c["name"]) for c in columns])
    listed = _told(spark, [(c["resource"], c["name"], c["type"], c["variant_of"]) for c in columns], "resource string, name string, type string, variant_of string")
    return listed.join(counts.unpivot([], [c["name"] for c in columns], "name", "n"), "name").select("resource", "name", "type", "variant_of", "n")


_FIELDS = {"external_id": "bigint", "amount": "double", "remark": "string"}
_ID = {"external_id": {"source": "event_id"}}
_PROJECTIONS = {
    "ids": {"nodes": _ID, "fields": _FIELDS, "identity": ["external_id"]},
    "amounts": {"nodes": _ID | {"amount": {"source": "value"}}, "fields": _FIELDS, "identity": ["external_id"]},
    "notes": {"nodes": _ID | {"remark": {"source": "note"}}, "fields": _FIELDS, "identity": ["external_id"]},
    "draft": {"nodes": _ID | {"remark": {"source": "note"}}, "fields": _FIELDS, "identity": ["external_id"], "status": "draft"},
}


@query("""
WITH g(load_id, projection, status) AS (VALUES
  ('one', 'ids', 'active'), ('one', 'amounts', 'active'), ('one', 'notes', 'invalid'), ('one', 'draft', 'draft'),
  ('two', 'ids', 'active'), ('two', 'amounts', 'active'), ('two', 'notes', 'active'), ('two', 'draft', 'draft'),
  ('three', 'ids', 'active'), ('three', 'amounts', 'needs_review'), ('three', 'notes', 'active'), ('three', 'draft', 'draft'))
SELECT load_id, projection, status, (SELECT count(*) FROM events WHERE load_id = 'one' OR load_id = 'two' AND event_type = 'click' OR load_id = 'three' AND event_type = 'view') AS rows FROM g
""")
def graded_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How four projections stand after every load that changed the columns, with the rows of that load by its ledger."""
    root = _root(_changing(spark, sf_dir), "events")
    grades = [(load, name, status) for _, load, of in resources.regraded(spark, root, _PROJECTIONS) for name, (status, _) in of.items()]
    return _told(spark, grades, "load_id string, projection string, status string").join(versioned.ledger(spark, root).select("load_id", "rows"), "load_id")


@query("""
SELECT 'shop_orders_k1' AS name, true AS dropped, NULL::BIGINT AS rows UNION ALL SELECT 'shop_customers_k1', true, NULL
UNION ALL SELECT 'shop_orders_k2', false, count(*) FROM orders UNION ALL SELECT 'shop_customers_k2', false, count(*) FROM customer
""")
def purge_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bindings of one source landed, one purged: what went, and what is left with its rows."""
    base = tables.scratch(spark, "purge")
    declared = {"orders": Resource(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"]), "customers": Resource(read(spark, sf_dir, "customer").select("c_custkey", "c_name"), ["c_custkey"])}
    for key in ("k1", "k2"):
        _land(spark, base, "one", declared, key)
    gone = resources.purge(spark, base, "shop", "k1", ["orders"])
    out = _told(spark, [(n, True, None) for n in gone], "name string, dropped boolean, rows long")
    for name in versioned.folders(spark, base):
        counted = versioned.table(spark, f"{base}/{name}").agg(F.count(F.lit(1)).alias("rows"))
        out = out.unionAll(counted.select(F.lit(name), F.lit(False), "rows"))
    return out


@query("""
WITH d AS (SELECT event_id, unnest(list_distinct([CAST(user_id AS VARCHAR), 'e' || event_id % 10])) AS external_id FROM events WHERE event_id % 4 <> 0)
SELECT external_id, count(*) AS deliveries, count(DISTINCT event_id) AS ids FROM d WHERE external_id IS NOT NULL GROUP BY 1
""")
def delivery_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which ids of the provider deliveries mention, by a parser of their bodies; every fourth body holds no ids."""
    events = read(spark, sf_dir, "events")
    item = lambda value: F.struct(value.alias("id"))
    user, own = F.col("user_id").cast("string"), F.concat(F.lit("e"), (F.col("event_id") % 10).cast("string"))
    body = F.to_json(F.struct(F.col("event_id").cast("string").alias("delivery"), F.when(F.col("event_id") % 4 != 0, F.array(item(user), item(own), item(user))).alias("changes")))
    kind = T.StructType([T.StructField("delivery", T.StringType()), T.StructField("changes", T.ArrayType(T.StructType([T.StructField("id", T.StringType())])))])
    raw = events.select(body.alias("body")).withColumn("_parsed", F.from_json("body", kind))
    parsed = deliveries.parsed(raw, F.col("_parsed.delivery"), F.col("_parsed.changes.id"))
    return parsed.select("fingerprint", F.explode("external_ids").alias("external_id")).groupBy("external_id").agg(F.count(F.lit(1)).alias("deliveries"), F.count_distinct("fingerprint").alias("ids"))
