"""The registered queries of the landing and projection engine, and their SQL.

Loads and changes are told apart by what rows say (a status, an event's type),
so that each query works on whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import mapping, records, redact
from .operators import checks, feeds, land, ledger, project, shape
from .plans import casting, grids, landings, reads, runs, scans, stores, streams  # noqa: F401
from .plans.registry import QUERIES, SQL, Query
from .plans.registry import query as _query
from .plans.registry import read as _read


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))


MAPPING = {
    "external_id": {"source": "event_id", "cast": "string"},
    "occurred_at": {"source": "ts"},
    "type": {"function": "upper", "args": [{"source": "event_type"}]},
    "k": {"source": "props", "json_path": "k", "cast": "integer"},
}


def _two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as a first load; clicks again, with their value doubled, as a second one that is merged in."""
    events = _events(spark, sf_dir)
    first = land.stamped(events, "b1", "r1", "000001")
    again = land.stamped(events.where("event_type = 'click'").withColumn("value", F.col("value") * 2), "b1", "r2", "000002")
    return land.merged(first, again, ["event_id"])


@_query("""
SELECT 'upsert' AS operation, CAST(event_id AS VARCHAR) AS external_id, upper(event_type) AS type,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events WHERE event_type IN ('click', 'view', 'purchase')
""")
def project_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _two_loads(spark, sf_dir)
    keep = mapping.all_of(landed, [{"field": "event_type", "op": "in", "value": ["click", "view", "purchase"]}])
    rows = project.projected(landed, mapping.compile_mapping(landed, MAPPING), ["external_id"], ["occurred_at", "type"], keep)
    return project.collapsed(rows, ["external_id"]).select("operation", "values.external_id", "values.type", "values.k")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_events(spark, sf_dir)


@_query("""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderstatus = 'F' THEN '000002' ELSE '000001' END AS _load_id
FROM orders
""")
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    old = land.stamped(orders, "b1", "r1", "000001")
    new = land.stamped(orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2), "b1", "r2", "000002")
    return land.merged(old, new, ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_totalprice", "_load_id")


@_query("""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice, o_orderstatus = 'P' AS _connector_deleted
FROM orders
""")
def merge_tombstone(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders")
    old = land.stamped(orders.select("o_orderkey", "o_custkey", "o_totalprice"), "b1", "r1", "000001")
    gone = land.stamped(orders.where("o_orderstatus = 'P'").select("o_orderkey", F.lit(True).alias(land.DELETED)), "b1", "r2", "000002")
    return land.merged(old, gone, ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_totalprice", land.DELETED)


@_query("""
SELECT event_id, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1
""")
def dedup_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return land.newest(events, ["user_id"], [F.col("ts"), F.col("event_id")]).select("event_id", "user_id", "event_type", "value")


@_query("""
SELECT conv_id, turn, role, text FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS k FROM conversations) WHERE k = 1
""")
def last_turn_per_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return land.newest(_read(spark, sf_dir, "conversations"), ["conv_id"], [F.col("turn")]).select("conv_id", "turn", "role", "text")


@_query("""
SELECT user_id, CASE WHEN bool_or(event_type = 'error') THEN 'delete' ELSE 'upsert' END AS operation
FROM events WHERE user_id IS NOT NULL GROUP BY user_id
""")
def collapse_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = land.stamped(_events(spark, sf_dir).withColumn(land.DELETED, F.col("event_type") == "error"), "b1", "r1", "000001")
    cells = mapping.compile_mapping(landed, {"user_id": {"source": "user_id"}, "value": {"source": "value"}})
    return project.collapsed(project.projected(landed, cells, ["user_id"]), ["user_id"]).select("values.user_id", "operation")


_STAGES = """
WITH w AS (SELECT l_orderkey, l_linenumber, l_returnflag, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax FROM lineitem),
u AS (SELECT l_orderkey, l_linenumber, l_returnflag, 'l_discount' AS stage, l_discount AS value, l_tax AS other FROM w
  UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag, 'l_tax', l_tax, l_discount FROM w)
"""


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem")
    blank = lambda c: F.when(F.col(c) != 0, F.col(c).cast("string")).otherwise("").alias(c)
    return lines.select("l_orderkey", "l_linenumber", "l_returnflag", blank("l_discount"), blank("l_tax"))


@_query(_STAGES + "SELECT l_orderkey, l_linenumber, stage, value FROM u WHERE value IS NOT NULL OR other IS NULL")
def unpivot_drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = shape.unpivoted(_wide(spark, sf_dir), ["l_discount", "l_tax"], ["l_orderkey", "l_linenumber"])
    return long.withColumn("value", F.col("value").cast("double"))


@_query(_STAGES + "SELECT l_orderkey, l_linenumber, l_returnflag, stage, value FROM u")
def unpivot_keep_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = shape.unpivoted(_wide(spark, sf_dir), ["l_discount", "l_tax"], ["l_orderkey", "l_linenumber", "l_returnflag"], drop_empty=False)
    return long.withColumn("value", F.col("value").cast("double"))


@_query("SELECT l_orderkey, l_linenumber, 'l_tax' AS stage, nullif(l_tax, 0) AS value FROM lineitem")
def unpivot_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _wide(spark, sf_dir)
    return shape.unpivoted(wide, shape.columns_like(wide, "l_t*"), ["l_orderkey", "l_linenumber"]).withColumn("value", F.col("value").cast("double"))


@_query("""
SELECT event_id, user_id FROM events
WHERE ts >= (SELECT max(ts) FROM events WHERE event_type = 'error') OR ts IS NULL
""")
def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events")
    last = events.where("event_type = 'error'").agg(F.max("ts")).first()[0]
    return land.incremental(events, "ts", last).select("event_id", "user_id")


@_query("SELECT 'events' AS resource, CAST(max(event_id) AS BIGINT) AS high, min(event_id) AS low, count(*) AS n FROM events")
def cursor_high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.high_water(_read(spark, sf_dir, "events"), "events", "event_id")


@_query("""
SELECT DISTINCT strftime(ts, '%Y-%m-%d %H:%M') AS load_id FROM events
EXCEPT SELECT strftime(ts, '%Y-%m-%d %H:%M') FROM events WHERE event_type = 'error'
""")
def outstanding_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = _read(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd HH:mm").alias("load_id"), "event_type")
    return land.outstanding(loads, loads.where("event_type = 'error'"))


@_query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def landed_reference_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _read(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    return land.landed_references(_read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), known, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@_query("""
SELECT c_custkey, c_nationkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal
FROM customer WHERE c_mktsegment <> 'MACHINERY'
""")
def writer_upsert_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _read(spark, sf_dir, "customer")
    target = customer.select("c_custkey", "c_nationkey", "c_acctbal")
    values = lambda balance: F.struct("c_custkey", "c_nationkey", balance.alias("c_acctbal")).alias("values")
    up = customer.where("c_mktsegment = 'BUILDING'").select(F.lit("upsert").alias("operation"), values(F.col("c_acctbal") + 100))
    gone = customer.where("c_mktsegment = 'MACHINERY'").select(F.lit("delete").alias("operation"), values(F.lit(None).cast("double")))
    return project.written(target, up.unionByName(gone), ["c_nationkey", "c_custkey"])


@_query("""
SELECT 'c' || c_custkey AS id, 2 AS depth FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'
UNION ALL SELECT 'n' || n_nationkey, 1 FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'
UNION ALL SELECT 'r' || r_regionkey, 0 FROM region WHERE r_name = 'ASIA'
""")
def folder_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    node = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    region, nation, customer = (_read(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    tree = (
        region.select(node("r", "r_regionkey").alias("id"), F.lit("top").alias("parent"))
        .unionAll(nation.select(node("n", "n_nationkey"), node("r", "n_regionkey")))
        .unionAll(customer.select(node("c", "c_custkey"), node("n", "c_nationkey")))
    )
    root = region.where("r_name = 'ASIA'").select(node("r", "r_regionkey")).first()
    return feeds.subtree(spark, tree, root[0] if root else "")


@_query("""
SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_type, bool_or(event_type = 'error') AS deleted, count(*) AS changes
FROM events GROUP BY user_id
""")
def history_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    out = feeds.folded(events, ["user_id"], F.col("event_type") == "error", [F.col("ts"), F.col("event_id")])
    return out.select("user_id", F.col("last.event_type").alias("last_type"), "deleted", "changes")


@_query("""
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id, date_trunc('minute', ts) ORDER BY ts, event_id) <= 2 AS accepted FROM events
""")
def delivery_rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return land.by_window(_read(spark, sf_dir, "events"), ["user_id"], "ts", "event_id", "1 minute", 2).select("event_id", "user_id", "accepted")


_TEXTS = """
WITH t AS (SELECT c_custkey, substr(c_name, length(c_name) - 3) AS tail, c_acctbal FROM customer)
"""


@_query(_TEXTS + """
SELECT c_custkey, TRY_CAST(tail AS BIGINT) AS as_integer, CASE WHEN floor(c_acctbal) = c_acctbal THEN CAST(c_acctbal AS BIGINT) END AS whole,
  CASE WHEN floor(c_acctbal) <> c_acctbal THEN true ELSE false END AS failed
FROM t
""")
def cast_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "customer").select("c_custkey", F.expr("substring(c_name, length(c_name) - 3)").alias("tail"), "c_acctbal")
    cells = mapping.compile_mapping(df, {"as_integer": {"source": "tail", "cast": "integer"}, "whole": {"source": "c_acctbal", "cast": "integer"}})
    return df.select("c_custkey", cells["as_integer"].value.alias("as_integer"), cells["whole"].value.alias("whole"), cells["whole"].error.isNotNull().alias("failed"))


@_query("""
SELECT doc_id, quality = 1 AS good, toxic = 1 AS toxic FROM labels
""")
def cast_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "yes").when(F.col("quality") == 0, "No").alias("good"), F.col("toxic").alias("t"))
    cells = mapping.compile_mapping(df, {"good": {"source": "good", "cast": "boolean"}, "toxic": {"source": "t", "cast": "boolean"}})
    return df.select("doc_id", cells["good"].value.alias("good"), cells["toxic"].value.alias("toxic"))


@_query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
""")
def cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "d/M/yyyy").alias("d"))
    day = mapping.compile_mapping(df, {"day": {"source": "d", "cast": "date", "format": "%d/%m/%Y"}})["day"]
    return df.select("o_orderkey", day.value.cast("string").alias("day"))


@_query("""
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || ':' || o_orderstatus || ':' || lower(o_orderpriority) AS label, coalesce(nullif(o_orderstatus, 'O'), 'open') AS status FROM orders
""")
def map_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "orders").withColumn("known", F.nullif("o_orderstatus", F.lit("O")))
    colon = {"constant": ":"}
    cells = mapping.compile_mapping(df, {
        "label": {"function": "concat", "args": [{"source": "o_orderkey"}, colon, {"source": "o_orderstatus"}, colon, {"function": "lower", "args": [{"source": "o_orderpriority"}]}]},
        "status": {"function": "coalesce", "args": [{"source": "known"}, {"constant": "open"}]},
    })
    return df.select("o_orderkey", *[c.value.alias(k) for k, c in cells.items()])


@_query("""
SELECT event_type, count(*) AS seen, count(*) FILTER (CAST(json_extract_string(props, '$.k') AS BIGINT) IS NOT NULL) AS ok, count(*) FILTER (json_extract_string(props, '$.k') IS NULL) AS skipped
FROM events GROUP BY event_type
""")
def skip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = land.stamped(_events(spark, sf_dir), "b1", "r1", "000001")
    cells = mapping.compile_mapping(landed, MAPPING | {"type": {"source": "event_type"}})
    rows = project.projected(landed, cells, ["external_id"], ["k"])
    return rows.groupBy(F.col("values.type").alias("event_type")).agg(F.count(F.lit(1)).alias("seen"), F.count_if(F.col("error").isNull()).alias("ok"), F.count_if(F.col("error").isNotNull()).alias("skipped"))


@_query("SELECT count(*) FILTER (c_mktsegment <> 'BUILDING') AS foreign_rows FROM customer")
def tenant_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return land.foreign_rows(_read(spark, sf_dir, "customer").withColumn(land.BINDING, F.col("c_mktsegment")), "BUILDING")


@_query("""
WITH d AS (SELECT event_id, event_type, value, event_type = 'error' AS text FROM events)
SELECT event_id, CASE WHEN NOT text THEN value END AS value, CASE WHEN text THEN 'n/a' END AS value__v_string FROM d
""")
def drift_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events")
    first = events.where("event_type <> 'error'").select("event_id", "value")
    second = events.where("event_type = 'error'").select("event_id", F.lit("n/a").alias("value"))
    old, new = land.evolved(first, second)
    return old.unionByName(new)


#: The secrets' names once more, apart from the code that is checked.
_SECRETS = "((access|refresh|id|bearer|session|sas)?[_-]?token|secret|password|passwd|pwd|api[_-]?key|client[_-]?secret|private[_-]?key|credential|assertion|authorization|auth|tempauth|signature|sig|passphrase|connection[_-]?string|dsn)"


def _masked_sql(text: str) -> str:
    """Values in double quotes, in single ones, and without, one after the other; what is masked masks again to itself."""
    out = f"regexp_replace(regexp_replace({text}, '\\beyJ[A-Za-z0-9_-]{{4,}}\\.[A-Za-z0-9_-]{{4,}}\\.[A-Za-z0-9_-]*', '***', 'g'), '(?i)\\b(bearer|basic|token|apikey)\\s+[A-Za-z0-9._~+/=-]+', '\\1 ***', 'g')"
    for quote in ('"', "''"):
        out = f"regexp_replace({out}, '(?i)([\"'']?\\b{_SECRETS}\\b[\"'']?[ \\t]*[=:][ \\t]*){quote}[^{quote}\\n]*[ \\t][^{quote}\\n]*{quote}', '\\1***', 'g')"
    for quote in ('"', "''", ""):
        out = f"regexp_replace({out}, '(?i)([\"'']?\\b{_SECRETS}\\b[\"'']?[ \\t]*[=:][ \\t]*){quote}[^\\s,;&)\\]}}''\"]+{quote}', '\\1{quote}***{quote}', 'g')"
    return out


@_query(f"SELECT doc_id, {_masked_sql('text')} AS text FROM documents")
def redact_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", redact.redacted(F.col("text")).alias("text"))


@_query(f"SELECT conv_id, turn, {_masked_sql(chr(39) + '{{' + chr(34) + 'refresh_token' + chr(34) + ': ' + chr(34) + chr(39) + ' || conv_id || ' + chr(39) + chr(34) + ', Token ' + chr(39) + ' || turn || ' + chr(39) + ', pwd=' + chr(39) + ' || role || ' + chr(39) + '}} ' + chr(39) + ' || text')} AS text FROM conversations")
def redact_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credentials put before every turn: a quoted name, a scheme, a bare pair."""
    turns = _read(spark, sf_dir, "conversations")
    text = F.concat(F.lit('{{"refresh_token": "'), F.col("conv_id").cast("string"), F.lit('", Token '), F.col("turn").cast("string"), F.lit(", pwd="), F.col("role"), F.lit("}} "), F.col("text"))
    return turns.select("conv_id", "turn", redact.redacted(text).alias("text"))


_URL_SQL = """
WITH u AS (SELECT page_id, regexp_replace(url, '[.,;:)\\]}>''"]+$', '') AS bare, coalesce(regexp_extract(url, '[.,;:)\\]}>''"]+$'), '') AS behind FROM pages WHERE url IS NOT NULL),
h AS (SELECT *, split_part(bare, '#', 1) AS whole FROM u),
q AS (SELECT *, split_part(whole, '?', 1) AS head, CASE WHEN contains(whole, '?') THEN substr(whole, length(split_part(whole, '?', 1)) + 2) ELSE '' END AS query FROM h),
p AS (SELECT *, list_filter(string_split(query, '&'), lambda x: x <> '') AS pieces FROM q)
SELECT page_id, regexp_replace(head, '^([^/]*//)[^/]*@', '\\1')
  || CASE WHEN len(pieces) > 0 THEN '?' || array_to_string(list_transform(pieces, lambda x: CASE
       WHEN lower(split_part(x, '=', 1)) NOT IN (SAFE) THEN split_part(x, '=', 1) || '=%2A%2A%2A' WHEN contains(x, '=') THEN x ELSE x || '=' END), '&') ELSE '' END
  || CASE WHEN length(bare) > length(whole) + 1 THEN '#***' ELSE '' END || behind AS url
FROM p UNION ALL SELECT page_id, NULL FROM pages WHERE url IS NULL
""".replace("SAFE", ", ".join(f"'{n}'" for n in redact.SAFE))


@_query(_URL_SQL)
def scrub_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "pages").select("page_id", redact.scrubbed_url(F.col("url")).alias("url"))


@_query("""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS row_number FROM documents)
SELECT doc_id, row_number, len(string_split(line, ' ')) AS width, nullif(trim(string_split(line, ' ')[1]), '') AS first_cell
FROM l WHERE trim(line, ' ') <> ''
""")
def grid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = shape.grid_rows(_read(spark, sf_dir, "documents"), "doc_id", "text")
    return grid.select("doc_id", "row_number", F.size("cells").cast("long").alias("width"), F.get("cells", 0).alias("first_cell"))


@_query("""
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_size < 10 AS is_folder, p_size < 20 AS is_native,
  CASE WHEN p_size >= 10 THEN CAST(p_size AS BIGINT) END AS size, p_brand AS parent_id
FROM part
""")
def flatten_drive_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part")
    mime = F.when(F.col("p_size") < 10, records.FOLDER_MIME).when(F.col("p_size") < 20, records.NATIVE_PREFIX + "document").otherwise("text/plain")
    size = F.when(F.col("p_size") >= 10, F.col("p_size").cast("string")).otherwise("-")
    raw = F.to_json(F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), mime.alias("mimeType"), size.alias("size"), F.array("p_brand", "p_type").alias("parents")))
    return records.drive_files(part.select(raw.alias("raw"))).select("id", "name", "is_folder", "is_native", "size", "parent_id")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as items of a drive: overdrawn ones are deleted, those of nation 0 are folders; every third has no user."""
    name = F.struct(F.col("c_mktsegment").alias("displayName"))
    who = F.struct(F.when(F.col("c_custkey") % 3 != 0, name).alias("user"), F.when(F.col("c_custkey") % 3 == 0, name).alias("device"))
    parent = F.struct(F.col("c_nationkey").cast("string").alias("id"), F.concat(F.lit("/drive/root:/A%20+b/"), F.col("c_mktsegment")).alias("path"))
    empty = F.struct(F.lit(None).cast("string").alias("state"))
    raw = F.to_json(F.struct(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), parent.alias("parentReference"), who.alias("createdBy"),
        F.when(F.col("c_nationkey") == 0, empty).alias("folder"), F.when(F.col("c_acctbal") < 0, empty).alias("deleted"),
    ))
    return records.drive_items(_read(spark, sf_dir, "customer").select(raw.alias("raw")), drive_id="d1")


@_query("""
SELECT CAST(c_custkey AS VARCHAR) AS id, '/A +b/' || c_mktsegment || '/' || c_name AS path, CAST(c_nationkey AS VARCHAR) AS parent_id,
  'd1' AS drive_id, c_nationkey = 0 AS is_folder, c_mktsegment AS created_by, c_acctbal < 0 AS deleted
FROM customer
""")
def flatten_drive_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir).select("id", "path", "parent_id", "drive_id", "is_folder", "created_by", "deleted")


@_query("""
SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_acctbal >= 0 THEN c_name END AS name, c_acctbal < 0 AS _connector_deleted
FROM customer WHERE (c_acctbal < 0 OR c_nationkey <> 0) AND ends_with(c_name, '7')
""")
def delta_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.delta(_items(spark, sf_dir), glob="*7").select("id", "name", land.DELETED)


@_query("""
SELECT CAST(conv_id AS VARCHAR) || '-' || turn AS id, role AS subject, epoch_ms(turn * 1000) AS internal_date, nullif(left(text, 200), '') AS body_text
FROM conversations
""")
def flatten_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    data = F.regexp_replace(F.translate(F.regexp_replace(F.base64(F.col("text").cast("binary")), "\\s", ""), "+/", "-_"), "=+$", "")
    part = F.struct(F.lit("text/plain").alias("mimeType"), F.struct(data.alias("data")).alias("body"))
    payload = F.struct(
        F.lit("multipart/mixed").alias("mimeType"), F.array(header("Subject", F.lit("old")), header("SUBJECT", F.col("role"))).alias("headers"),
        F.array(F.struct(F.lit("text/html").alias("mimeType"), F.struct(F.lit("PGI+").alias("data")).alias("body"), F.array(part).alias("parts"))).alias("parts"),
    )
    raw = F.to_json(F.struct(F.concat_ws("-", "conv_id", "turn").alias("id"), (F.col("turn") * 1000).cast("string").alias("internalDate"), payload.alias("payload")))
    mail = records.mail_messages(_read(spark, sf_dir, "conversations").select(raw.alias("raw")), body_chars=200)
    return mail.select("id", "subject", F.col("internal_date").cast("timestamp_ntz").alias("internal_date"), "body_text")


@_query("""
SELECT o_orderkey AS "Id", CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS owner, o_orderdate AS "SystemModstamp", o_orderstatus = 'P' AS _connector_deleted FROM orders
""")
def clean_sobjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelope = F.struct(F.lit("Order").alias("type"))
    owner = F.struct(envelope.alias("attributes"), F.col("o_custkey").alias("Id"))
    orders = _read(spark, sf_dir, "orders").select(
        envelope.alias("attributes"), F.col("o_orderkey").alias("Id"), owner.alias("Owner"), F.col("o_orderdate").alias("SystemModstamp"), (F.col("o_orderstatus") == "P").alias("IsDeleted")
    )
    return records.sobjects(orders, "SystemModstamp").select("Id", F.col("Owner.Id").alias("owner"), "SystemModstamp", land.DELETED)


@_query("""
WITH asia AS (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'),
s AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal < 0 AS gone, c_nationkey IN (FROM asia) AS was,
    c_nationkey IN (FROM asia) AND c_nationkey <> (SELECT max(n_nationkey) FROM asia) AS inside, c_acctbal < 0 OR c_mktsegment = 'BUILDING' AS changed
  FROM customer)
SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN inside AND NOT gone THEN c_name END AS name, NOT (inside AND NOT gone) AS _connector_deleted
FROM s WHERE (inside AND NOT gone AND changed) OR (was AND NOT (inside AND NOT gone))
""")
def scoped_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers below ASIA are landed; its last nation moves to the top, overdrawn customers go, those of one segment change."""
    region, nation, customer = (_read(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    of = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    asia = nation.join(F.broadcast(region.where("r_name = 'ASIA'")), F.col("n_regionkey") == F.col("r_regionkey"))
    folders = region.select(of("r", "r_regionkey").alias("id"), F.lit("top").alias("parent")).unionAll(nation.select(of("n", "n_nationkey"), of("r", "n_regionkey")))
    files = customer.select(F.col("c_custkey").cast("string").alias("id"), of("n", "c_nationkey").alias("parent"), F.col("c_name").alias("name"), "c_nationkey", "c_acctbal", "c_mktsegment")
    landed = files.join(F.broadcast(asia), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("id", "parent", "name")
    changed = files.where("c_acctbal < 0 or c_mktsegment = 'BUILDING'").select("id", "parent", "name", F.lit(False).alias("is_folder"), (F.col("c_acctbal") < 0).alias("gone"), F.lit(2).alias("seq"))
    earlier = changed.withColumn("gone", ~F.col("gone")).withColumn("seq", F.lit(1))
    moved = asia.agg(F.max("n_nationkey").alias("n")).select(of("n", "n").alias("id"), F.lit("top").alias("parent"), F.lit("moved").alias("name"), F.lit(True).alias("is_folder"), F.lit(False).alias("gone"), F.lit(1).alias("seq"))
    root = region.where("r_name = 'ASIA'").select(of("r", "r_regionkey")).first()
    return feeds.scoped(spark, folders, landed, changed.unionAll(earlier).unionAll(moved), root[0] if root else "").select("id", "name", land.DELETED)


@_query("""
SELECT event_id, CASE WHEN event_type NOT IN ('click', 'error') THEN 'filtered' WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN event_type = 'error' THEN 'day: not date: oops' END AS error
FROM events
""")
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).withColumn("day", F.when(F.col("event_type") == "error", "oops").otherwise(F.left("ts", F.lit(10))))
    landed = land.stamped(events, "b1", "r1", "000001")
    cells = mapping.compile_mapping(landed, {"id": {"source": "event_id"}, "day": {"source": "day", "cast": "date"}})
    keep = mapping.all_of(landed, [{"field": "event_type", "op": "in", "value": ["click", "error"]}])
    return checks.preview(landed, cells, ["id"], filters=keep, limit=None).select("source.event_id", "status", "error")


@_query("SELECT count(*) AS rows, count(*) FILTER (o_orderstatus = 'P') AS unstamped, count(*) FILTER (o_orderstatus = 'F') AS foreign_rows FROM orders")
def landing_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = land.stamped(_read(spark, sf_dir, "orders"), "b1", "r1", "000001")
    binding = F.when(F.col("o_orderstatus") == "F", "b2").when(F.col("o_orderstatus") != "P", "b1")
    return checks.landing_counts(landed.withColumn(land.BINDING, binding), "b1")


@_query("SELECT count(*) AS tombstones, count(*) FILTER (o_orderkey % 7 = 0) AS keyless, count(*) FILTER (o_orderpriority IS NOT NULL) AS with_values FROM orders WHERE o_orderstatus = 'P'")
def tombstone_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select(F.expr("nullif(o_orderkey, if(o_orderkey % 7 = 0, o_orderkey, null))").alias("id"), "o_orderpriority", "o_orderdate", (F.col("o_orderstatus") == "P").alias(land.DELETED))
    return checks.tombstone_counts(land.stamped(orders, "b1", "r1", "000001"), ["id"], "o_orderdate")


#: field, literal and SQL of each filter's query over ``orders``.
_FILTERS = {
    "eq": ("o_orderstatus", "F", "o_orderstatus = 'F'"), "ne": ("o_orderstatus", "F", "o_orderstatus <> 'F'"),
    "gt": ("o_totalprice", 100000, "o_totalprice > 100000"), "lt": ("o_totalprice", 100000, "o_totalprice < 100000"),
    "gte": ("o_custkey", 100, "o_custkey >= 100"), "lte": ("o_custkey", 100, "o_custkey <= 100"),
    "in": ("o_orderstatus", ["F", "P"], "o_orderstatus IN ('F', 'P')"), "not_in": ("o_orderstatus", ["F", "P"], "o_orderstatus NOT IN ('F', 'P')"),
    "contains": ("o_orderpriority", "IG", "contains(o_orderpriority, 'IG')"), "startswith": ("o_orderpriority", "1", "starts_with(o_orderpriority, '1')"),
    "endswith": ("o_orderpriority", "M", "ends_with(o_orderpriority, 'M')"), "is_null": ("known", None, "known IS NULL"), "is_not_null": ("known", None, "known IS NOT NULL"),
}


def _filter_query(op: str, field: str, literal: object) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = _read(spark, sf_dir, "orders").withColumn("known", F.nullif("o_orderstatus", F.lit("O")))
        return orders.where(mapping.condition(orders, field, op, literal)).select("o_orderkey", field)

    return run


for _op, (_field, _literal, _where) in _FILTERS.items():
    QUERIES[f"filter_{_op}"] = _filter_query(_op, _field, _literal)
    SQL[f"filter_{_op}"] = f"SELECT o_orderkey, {_field} FROM (SELECT *, nullif(o_orderstatus, 'O') AS known FROM orders) WHERE {_where}"


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
