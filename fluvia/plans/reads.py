"""Queries of cursors, folds with what was fetched, JSON read back, previews, samples, scopes, and casts and filters of the mapping language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import mapping, records, redact
from ..operators import checks, cursors, dispatch, feeds, grid, land, pages
from ..sources import tables, versioned
from .registry import query, read


@query("""
SELECT CAST(user_id AS VARCHAR) AS id, bool_or(event_type = 'error') OR min(user_id) % 7 = 0 AS _connector_deleted,
  CASE WHEN NOT bool_or(event_type = 'error') AND min(user_id) % 7 <> 0 THEN count(*) END AS n
FROM events WHERE user_id IS NOT NULL AND event_type <> 'view' GROUP BY user_id
""")
def history_fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of users folded with what was fetched for them: those with an error are deleted, every seventh was gone when it was fetched."""
    events = read(spark, sf_dir, "events").where("user_id is not null").withColumn("id", F.col("user_id").cast("string"))
    changes = events.where("event_type <> 'view'").select("id", "event_type")
    fetched = events.where("user_id % 7 <> 0").groupBy("id").agg(F.count_if(F.col("event_type") != "view").alias("n"))
    return feeds.fetched_changes(changes, fetched, "id", F.col("event_type") == "error").select("id", land.DELETED, "n")


@query("""
WITH m AS (SELECT max(ts) AS last FROM events WHERE event_id <= (SELECT max(event_id) // 2 FROM events))
SELECT 'one' AS load_id, count(*) AS rows FROM events WHERE event_id <= (SELECT max(event_id) // 2 FROM events)
UNION ALL SELECT 'two', count(*) FROM events, m WHERE ts >= last OR ts IS NULL
UNION ALL SELECT 'three', count(*) FROM events WHERE ts >= (SELECT max(ts) FROM events) OR ts IS NULL
""")
def landing_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows three loads read, each from the cursor that the commit before left; the boundary is read again."""
    root = tables.scratch(spark, "cursor")
    versioned.create(spark, root, ["event_id"], 8)
    events = read(spark, sf_dir, "events")
    half = events.agg(F.max("event_id")).first()[0] // 2
    for load, df in (("one", events.where(F.col("event_id") <= half)), ("two", events), ("three", events)):
        cursors.landed_since(df, root, load, "ts", binding="b1")
    return versioned.ledger(spark, root).select("load_id", "rows")


@query("""
SELECT vec_id, CASE WHEN label % 2 = 0 THEN len(embedding) END AS n, CASE WHEN label % 2 = 0 THEN CAST(embedding[1] AS DOUBLE) END AS first, CASE WHEN label % 2 = 1 THEN 'not json' END AS embedding__v_string
FROM embeddings
""")
def json_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors landed as JSON and read as arrays again; what doesn't parse stays text."""
    landed = land.nested_to_json(read(spark, sf_dir, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>")))
    meta = landed.schema["embedding"].metadata
    broken = landed.withColumn("embedding", F.when(F.col("label") % 2 == 1, "not json").when(F.col("label") % 2 == 0, F.col("embedding")).alias("embedding", metadata=meta)).withMetadata("embedding", meta)
    out = land.decoded(broken)
    return out.select("vec_id", F.when(F.col("embedding").isNotNull(), F.size("embedding")).cast("long").alias("n"), F.get("embedding", 0).alias("first"), "embedding__v_string")


@query("""
WITH e AS (SELECT *, row_number() OVER (ORDER BY event_type, event_id) AS k FROM events ORDER BY k LIMIT 60)
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'filtered' WHEN event_id % 2 = 0 THEN 'error' ELSE 'ok' END AS status, false AS truncated FROM e
""")
def preview_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A preview of the first sixty rows in load order, within its budget of bytes."""
    events = read(spark, sf_dir, "events").withColumn("third", (F.col("event_id") % 3).cast("int")).withColumn("word", F.when(F.col("event_id") % 2 == 0, "x").otherwise("7"))
    landed = land.stamped(events, "b1", "r1", "1").withColumns({land.LOAD: F.col("event_type"), land.ROW: F.lpad(F.col("event_id").cast("string"), 15, "0")})
    cells = mapping.compile_mapping(landed, {"id": {"source": "event_id"}, "n": {"source": "word", "cast": "integer"}})
    keep = mapping.all_of(landed, [{"field": "third", "op": "ne", "value": 0}])
    return checks.preview(landed, cells, ["id"], filters=keep, limit=60).select("source.event_id", "status", "truncated")


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderpriority, o_orderkey LIMIT 100")
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample is at most a hundred rows in load order, without internal columns."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderpriority").alias(land.LOAD), F.lpad(F.col("o_orderkey").cast("string"), 15, "0").alias(land.ROW))
    return pages.sampled(orders, 5000)


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def load_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of two loads, and those of none."""
    orders = read(spark, sf_dir, "orders").withColumn(land.LOAD, F.col("o_orderpriority"))
    return land.in_loads(orders, ["1-URGENT", "2-HIGH"]).unionByName(land.in_loads(orders, [])).select("o_orderkey")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE o_orderstatus END AS status, CASE WHEN o_orderstatus = 'O' THEN -1 ELSE ascii(o_orderstatus) END AS code,
  '{"key":' || o_orderkey || ',"who":"C' || o_custkey || '"}' AS about, o_orderkey * 10 + 7 AS number
FROM orders
""")
def map_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defaults for what is null, which a cast doesn't touch; objects; a cast of a function's result."""
    orders = read(spark, sf_dir, "orders").withColumn("known", F.nullif("o_orderstatus", F.lit("O"))).withColumn("code", F.ascii("known").cast("string"))
    cells = mapping.compile_mapping(orders, {
        "status": {"source": "known", "default": "open"}, "code": {"source": "code", "cast": "integer", "default": -1},
        "about": {"object": {"key": {"source": "o_orderkey"}, "who": {"function": "concat", "args": [{"constant": "C"}, {"source": "o_custkey"}]}}},
        "number": {"function": "concat", "args": [{"source": "o_orderkey"}, {"constant": 7}], "cast": "integer"},
    })
    return orders.select("o_orderkey", cells["status"].value.alias("status"), cells["code"].value.alias("code"), F.to_json(cells["about"].value).alias("about"), cells["number"].value.alias("number"))


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice AS price, CAST(l_quantity AS BIGINT) AS quantity, l_returnflag = 'R' AS failed,
  CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS DOUBLE) + 0.5 END AS near FROM lineitem
""")
def cast_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as people write them: a currency sign, groups, a decimal comma; texts that Spark would take for numbers are none."""
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag",
        F.concat(F.lit("€ "), F.translate(F.format_number("l_extendedprice", 2), ",.", ".,")).alias("price"), F.concat(F.lit("#"), F.col("l_quantity").cast("long").cast("string")).alias("quantity"),
        F.concat(F.col("l_quantity").cast("long").cast("string"), F.when(F.col("l_returnflag") == "R", "d").otherwise("")).alias("odd"),
        F.concat(F.col("l_quantity").cast("long").cast("string"), F.when(F.col("l_returnflag") == "N", "f").otherwise(".5e0")).alias("near"),
    )
    cells = mapping.compile_mapping(lines, {
        "price": {"source": "price", "cast": "float", "strip": "€. ", "decimal_separator": ","}, "quantity": {"source": "quantity", "cast": "integer", "strip": "#"},
        "odd": {"source": "odd", "cast": "float"}, "near": {"source": "near", "cast": "float"},
    })
    return lines.select("l_orderkey", "l_linenumber", cells["price"].value.alias("price"), cells["quantity"].value.alias("quantity"), cells["odd"].error.isNotNull().alias("failed"), cells["near"].value.alias("near"))


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber < 4 THEN CAST(l_quantity AS VARCHAR) || '00000000000000001' END AS exact FROM (SELECT *, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.0' AS q FROM lineitem) t(l_orderkey, l_partkey, l_suppkey, l_linenumber, q0, p, d, x, f, s, h, l_quantity)
""")
def cast_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eighteen decimals are kept; with one more the number is refused, not rounded."""
    lines = read(spark, sf_dir, "lineitem")
    text = F.concat(F.col("l_quantity").cast("long").cast("string"), F.when(F.col("l_linenumber") < 4, ".000000000000000001").otherwise(".0000000000000000001"))
    df = lines.select("l_orderkey", "l_linenumber", text.alias("t"))
    cell = mapping.compile_node(df, {"source": "t", "cast": "decimal"})
    return df.select("l_orderkey", "l_linenumber", cell.value.cast("string").alias("exact"))


@query("""
SELECT event_id, CASE WHEN event_type <> 'error' THEN props END AS props, event_type = 'error' AS failed FROM events
""")
def cast_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON is checked and stays text; scalars are JSON too, a broken text is an error."""
    events = read(spark, sf_dir, "events").withColumn("t", F.when(F.col("event_type") == "error", F.concat(F.col("props"), F.lit("}"))).otherwise(F.col("props")))
    cell = mapping.compile_node(events, {"source": "t", "cast": "json"})
    return events.select("event_id", cell.value.alias("props"), cell.error.isNotNull().alias("failed"))


@query("""
SELECT o_orderkey, o_custkey % 10 = 7 AS a, o_custkey % 10 = 7 AS b, o_orderstatus <> 'O' AS c, o_custkey % 10 <> 0 AS d, false AS e FROM orders
""")
def filter_loosely(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number in a text, a text for a number, truth of texts and numbers, and what is never equal."""
    orders = read(spark, sf_dir, "orders").withColumn("digit", (F.col("o_custkey") % 10)).withColumn("text", F.concat(F.col("digit").cast("string"), F.lit(".0"))).withColumn("blank", F.when(F.col("o_orderstatus") == "O", "").otherwise("x"))
    asked = {"a": ("text", 7), "b": ("digit", "7.0"), "c": ("blank", True), "d": ("digit", True), "e": ("digit", "seven")}
    return orders.select("o_orderkey", *[mapping.condition(orders, field, "eq", value).alias(name) for name, (field, value) in asked.items()])


@query("""
SELECT page_id, 'failed for https://***@host/x?page=' || page_id || '&key=%2A%2A%2A, token=***' AS message FROM pages
""")
def scrub_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with an address, a name and a secret in them; what is no secret stays."""
    pages_ = read(spark, sf_dir, "pages")
    n = F.col("page_id").cast("string")
    text = F.concat(F.lit("failed for https://user"), n, F.lit(":pw"), n, F.lit("@host/x?page="), n, F.lit("&key=k"), n, F.lit(", token=t"), n)
    return pages_.select("page_id", F.replace(redact.scrubbed(text), F.lit("https://host"), F.lit("https://***@host")).alias("message"))


@query("SELECT CAST(event_id AS VARCHAR) AS external_id, value FROM events WHERE event_type <> 'error'")
def projection_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full replay takes the whole table, whichever loads it came by, in place of what the target held."""
    landing, target = tables.scratch(spark, "landing"), tables.scratch(spark, "target")
    versioned.create(spark, landing, ["event_id"], 8)
    versioned.create(spark, target, ["external_id"], 8)
    events = read(spark, sf_dir, "events").select("event_id", "event_type", "value")
    nodes = {"external_id": {"source": "event_id", "cast": "string"}, "value": {"source": "value"}}
    run = lambda name, full: dispatch.dispatched(spark, landing, target, lambda df: mapping.compile_mapping(df, nodes), ["external_id"], name, full=full)
    versioned.merge(land.stamped(events.withColumn("value", F.lit(-1.0)), "b1", "r1", "1"), landing, "1")
    run("p1", False)
    versioned.merge(land.stamped(events.withColumn(land.DELETED, F.col("event_type") == "error"), "b1", "r2", "2"), landing, "2")
    run("p2", True)
    return versioned.table(spark, target)


@query("""
SELECT o_orderkey AS "Id", o_totalprice AS "Total", o_orderdate AS "Modified" FROM orders
WHERE (o_orderstatus = 'F' OR o_orderpriority = '1-URGENT') AND o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 1 YEAR FROM orders) AND o_orderstatus <> 'P'
""")
def select_sobjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields and a condition with an ``or`` as configured, from a cursor on."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("Id"), F.col("o_totalprice").alias("Total"), F.col("o_orderdate").alias("Modified"), F.col("o_orderstatus").alias("Status"), F.col("o_orderpriority").alias("Priority"), (F.col("o_orderstatus") == "P").alias("IsDeleted"))
    newest = orders.agg((F.max("Modified") - F.expr("interval 1 year")).alias("m")).first().m
    return records.selected(orders, ["total", "TOTAL", "id"], "Status = 'F' or Priority = '1-URGENT'", "Modified", newest, deletes=False)


@query("""
WITH c AS (SELECT c_mktsegment AS sheet, c_custkey + 1 AS row_number, c_acctbal < 0 AS keyless FROM customer)
SELECT sheet, CAST(count(*) AS BIGINT) AS n, array_to_string((list(row_number ORDER BY row_number))[:20], ',') AS first FROM c WHERE keyless GROUP BY sheet
""")
def grid_keyless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of sheets without a key: how many, and the first of them."""
    customer = read(spark, sf_dir, "customer")
    cells = F.array(F.when(F.col("c_acctbal") >= 0, F.col("c_custkey").cast("string")), F.col("c_name"))
    rows = grid.records(customer.select(F.col("c_mktsegment").alias("sheet"), (F.col("c_custkey") + 1).cast("long").alias("row_number"), cells.alias("cells")), header_row=None)
    return grid.keyless(rows, "column_1").select("sheet", "n", F.array_join(F.transform("first", lambda x: x.cast("string")), ",").alias("first"))
