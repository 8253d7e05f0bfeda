"""Exact batches, versioned tables, exactly-once projections, writers, database scans, deep mails and exact decimals."""

import base64
import json
import sqlite3
import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fluvia.functions import casts, mapping, records
from fluvia.operators import dispatch, land, pages, project
from fluvia.sources import database, versioned


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_batches_are_exact_over_many_partitions(spark, adaptive):
    """400,000 wide rows: every batch has 500 rows, and they are those of the order."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        wide = spark.range(400_000).select(F.lpad((F.col("id") % 7).cast("string"), 3, "0").alias(land.LOAD), F.lpad(F.col("id").cast("string"), 9, "0").alias(land.ROW), F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("wide"))
        got = pages.batched(wide.repartition(16))
        sizes = got.groupBy("batch_index").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(land.LOAD, land.ROW)).alias("first"), F.max(F.struct(land.LOAD, land.ROW)).alias("last")).orderBy("batch_index").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert [r.batch_index for r in sizes] == list(range(800)) and {r.n for r in sizes} == {500}
    assert all(tuple(a.last) < tuple(b.first) for a, b in zip(sizes, sizes[1:]))


def test_pages_know_whether_there_is_another(spark):
    items = spark.range(5)
    rows, cursor = pages.page(items, ["id"], None, 2)
    assert [r.id for r in rows.collect()] == [0, 1] and cursor == "2"
    rows, cursor = pages.page(items, ["id"], "4", 2)
    assert [r.id for r in rows.collect()] == [4] and cursor is None
    assert pages.page(items, ["id"], "3", 2)[1] is None


# Versioned tables


def _table(spark, path, key=("id",), buckets=8):
    root = f"file://{path}/table"
    versioned.create(spark, root, key, buckets)
    return root


def _frame(spark, rows, schema="id string, v int"):
    return spark.createDataFrame(rows, schema)


def _rows(spark, root, *columns):
    return sorted(tuple(r) for r in versioned.table(spark, root).select(*(columns or ("id", "v"))).collect())


def test_a_merge_rewrites_the_buckets_it_touches(spark, tmp_path):
    root = _table(spark, tmp_path, buckets=16)
    versioned.merge(_frame(spark, [(str(k), k) for k in range(200)]), root, "1")
    before = versioned.current(spark, root)
    after = versioned.merge(_frame(spark, [("7", -7), ("new", 1)]), root, "2")
    changed = [b for b in range(16) if before.files.get(b) != after.files.get(b)]
    assert 1 <= len(changed) <= 2
    assert _rows(spark, root) == sorted([(str(k), k if k != 7 else -7) for k in range(200)] + [("new", 1)])
    assert versioned.table(spark, root, 1).count() == 200
    # A load that is landed is not landed again, and the log says what each had.
    versioned.merge(_frame(spark, [("7", 0)]), root, "2")
    assert [(r.version, r.load_id, r.rows) for r in versioned.ledger(spark, root).orderBy("version").collect()] == [(1, "1", 200), (2, "2", 2)]


def test_two_merges_at_once_lose_nothing(spark, tmp_path):
    root = _table(spark, tmp_path, buckets=4)
    versioned.merge(_frame(spark, [(str(k), 0) for k in range(50)]), root, "0")
    failed = []

    def work(n):
        try:
            versioned.merge(_frame(spark, [(str(k), n) for k in range(10 * n, 10 * n + 10)] + [(f"own {n}", n)]), root, f"load {n}")
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=work, args=(n,)) for n in range(1, 5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert _rows(spark, root) == sorted([(str(k), k // 10) for k in range(50)] + [(f"own {n}", n) for n in range(1, 5)])
    assert versioned.current(spark, root).number == 5


def test_a_writer_that_was_slower_takes_the_other_ones_rows_along(spark, tmp_path, monkeypatch):
    """The other commit falls between what a merge read and its own commit."""
    root = _table(spark, tmp_path, buckets=2)
    versioned.merge(_frame(spark, [("a", 1), ("b", 1)]), root, "1")
    real, other = versioned._committed, []

    def late(session, where, version):
        if version.load.get("load_id") == "slow" and not other:
            other.append(versioned.merge(_frame(spark, [("a", 2), ("c", 2, )]), root, "fast"))
        return real(session, where, version)

    monkeypatch.setattr(versioned, "_committed", late)
    versioned.merge(_frame(spark, [("b", 3), ("d", 3)]), root, "slow")
    assert _rows(spark, root) == [("a", 2), ("b", 3), ("c", 2), ("d", 3)]
    assert [r.load_id for r in versioned.ledger(spark, root).orderBy("version").collect()] == ["1", "fast", "slow"]


def test_what_is_not_committed_is_not_there(spark, tmp_path, monkeypatch):
    root = _table(spark, tmp_path)
    versioned.merge(_frame(spark, [("a", 1)]), root, "1")
    with monkeypatch.context() as m:
        m.setattr(versioned, "_committed", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            versioned.merge(_frame(spark, [("a", 2)]), root, "2")
    assert _rows(spark, root) == [("a", 1)]
    versioned.merge(_frame(spark, [("a", 2)]), root, "2")
    assert _rows(spark, root) == [("a", 2)]
    assert versioned.vacuum(spark, root, keep=1, hours=-1) > 0 and _rows(spark, root) == [("a", 2)]


def test_columns_come_and_change_and_a_table_is_replaced(spark, tmp_path):
    root = _table(spark, tmp_path)
    versioned.merge(_frame(spark, [("a", 1), ("b", 2), (None, 0)]), root, "1")
    versioned.merge(_frame(spark, [("b", "x", 1.5), (None, "0", 0.5)], "id string, v string, w double"), root, "2")
    assert sorted(map(str, (tuple(r) for r in versioned.table(spark, root).select("id", "v", "v__v_string", "w").collect()))) == sorted(map(str, [("a", 1, None, None), ("b", None, "x", 1.5), (None, 0, None, None), (None, 0, None, 0.5)]))
    versioned.replace(_frame(spark, [("z", True)], "id string, flag boolean"), root, "3")
    assert _rows(spark, root, "*") == [("z", True)]
    versioned.merge(_frame(spark, [("z", None)], "id string, flag boolean").withColumn("g", F.lit(True)), root, "4", gone="g")
    assert versioned.table(spark, root).count() == 0
    versioned.merge(_frame(spark, [], "id string, flag boolean"), root, "5")
    assert versioned.current(spark, root).number == 5 and versioned.table(spark, root).columns == ["id", "flag"]


def test_tenants_share_a_table(spark, tmp_path):
    root = _table(spark, tmp_path)
    for binding, v in (("b1", 1), ("b2", 2), ("b1", 3)):
        versioned.merge(land.stamped(_frame(spark, [("a", v)]), binding, "r", f"{binding}-{v}"), root, f"{binding}-{v}")
    assert _rows(spark, root, land.BINDING, "v") == [("b1", 3), ("b2", 2)]


# Projection


NODES = {"id": {"source": "id"}, "at": {"source": "ts", "cast": "datetime"}}


def _land(spark, root, load, rows):
    df = spark.createDataFrame(rows, f"id string, ts string, {land.DELETED} boolean")
    versioned.merge(land.stamped(df, "b", "r", load), root, load)


def _dispatch(spark, landing, target, run, **how):
    return dispatch.dispatched(spark, landing, target, lambda df: mapping.compile_mapping(df, NODES), ["id"], run, required=["at"], **how)


def test_a_load_is_projected_once(spark, tmp_path, monkeypatch):
    landing, target = _table(spark, tmp_path / "l"), _table(spark, tmp_path / "t")
    _land(spark, landing, "1", [("a", "2024-01-01", False), ("b", "2024-01-01", False), ("c", "soon", False)])
    with monkeypatch.context() as m:
        m.setattr(versioned, "_committed", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            _dispatch(spark, landing, target, "p1")
    assert _dispatch(spark, landing, target, "p1") == {"seen": 3, "filtered": 0, "skipped": 1, "written": 2, "deleted": 0}
    assert _dispatch(spark, landing, target, "p1") == {} and _dispatch(spark, landing, target, "p2") == {}
    _land(spark, landing, "2", [("b", None, True), ("d", "2024-01-02", False)])
    _land(spark, landing, "3", [("e", "2024-01-03", False)])
    assert _dispatch(spark, landing, target, "p3", most=1) == {"seen": 2, "filtered": 0, "skipped": 0, "written": 1, "deleted": 1}
    assert _dispatch(spark, landing, target, "p4") == {"seen": 1, "filtered": 0, "skipped": 0, "written": 1, "deleted": 0}
    assert [r.id for r in versioned.table(spark, target).orderBy("id").collect()] == ["a", "d", "e"]
    (bad,) = versioned.ledger(spark, target).where("run_id = 'p1'").select(F.explode("warnings").alias("w")).select("w.*").collect()
    assert bad.n == 1 and bad.reason.startswith("at: ") and len(bad.rows) == 1


def test_two_runs_do_not_take_one_load(spark, tmp_path):
    landing, target = _table(spark, tmp_path / "l"), _table(spark, tmp_path / "t")
    _land(spark, landing, "1", [("a", "2024-01-01", False)])
    rows = _frame(spark, [("a", None)], "id string, at timestamp")
    versioned.merge(rows, target, "p1", entry={"taken": ["1"]})
    with pytest.raises(versioned.Taken):
        versioned.merge(rows, target, "p2", entry={"taken": ["1"]})
    assert dispatch.outstanding(spark, landing, target).count() == 0


def test_a_run_that_may_skip_nothing_writes_nothing(spark, tmp_path):
    landing, target = _table(spark, tmp_path / "l"), _table(spark, tmp_path / "t")
    _land(spark, landing, "1", [("a", "2024-01-01", False), ("c", "soon", False)])
    with pytest.raises(project.InvalidRecord):
        _dispatch(spark, landing, target, "p1", policy="fail")
    assert versioned.current(spark, target).number == 0


def test_a_full_replay_replaces_the_scope(spark, tmp_path):
    landing, target = _table(spark, tmp_path / "l"), _table(spark, tmp_path / "t")
    _land(spark, landing, "1", [("a", "2024-01-01", False), ("b", "2024-01-01", False)])
    _dispatch(spark, landing, target, "p1")
    versioned.merge(_frame(spark, [("stale", None)], "id string, at timestamp"), target, "by hand")
    _land(spark, landing, "2", [("a", None, True)])
    counts = _dispatch(spark, landing, target, "p2", full=True)
    assert counts["seen"] == 2 and [r.id for r in versioned.table(spark, target).collect()] == ["b"]
    assert _dispatch(spark, landing, target, "p3") == {}


def _records(spark, rows):
    return spark.createDataFrame(rows, "operation string, values struct<id: int, v: string>")


def test_batches_of_two(spark, tmp_path):
    """2, 2, 1; deletions last; what the writer says counts, and what it does not say is taken as done."""
    log = str(tmp_path / "log")

    def writer(batch, context):
        with open(log, "a") as f:
            f.write(json.dumps([context.run, context.batch_index, [(r["operation"], r["identity"]["id"], r["values"].get("v")) for r in batch]]) + "\n")
        return dispatch.Result(written=1, skipped=1, warnings=["twice", "late"]) if context.batch_index == 0 else None if context.batch_index == 1 else 7

    outcomes = dispatch.delivered(_records(spark, [("upsert", (3, "c")), ("delete", (0, None)), ("upsert", (1, "a")), ("upsert", (4, None)), ("upsert", (2, "b"))]), writer, ["id"], "r1", 2)
    assert sorted(tuple(r)[:4] for r in outcomes.collect()) == [(0, 1, 0, 1), (1, 2, 0, 0), (2, 0, 1, 0)]
    outcomes.count()
    calls = sorted(json.loads(x) for x in open(log))
    assert calls == [["r1", 0, [["upsert", 1, "a"], ["upsert", 2, "b"]]], ["r1", 1, [["upsert", 3, "c"], ["upsert", 4, None]]], ["r1", 2, [["delete", 0, None]]]]
    assert dispatch.totals(outcomes) == {"written": 3, "deleted": 1, "skipped": 1, "warnings": ["twice", "late"]}
    assert dispatch.totals(dispatch.delivered(_records(spark, []), writer, ["id"], "r2")) == {"written": 0, "deleted": 0, "skipped": 0, "warnings": []}


def test_a_writer_that_fails_fails_the_run(spark):
    def writer(batch, context):
        raise ValueError("host is down")

    with pytest.raises(Exception, match="host is down"):
        dispatch.delivered(_records(spark, [("upsert", (1, "a"))]), writer, ["id"], "r1")


# Databases


def _opener():
    # A function of its own, which travels to the workers as it is.
    def opened(path):
        return sqlite3.connect(path)

    return opened


_open = _opener()


@pytest.fixture
def shards(tmp_path):
    paths = []
    for n in range(2):
        path = str(tmp_path / f"{n}.db")
        with sqlite3.connect(path) as c:
            c.execute("create table t (id integer, total integer, note text, at text)")
            c.executemany("insert into t values (?, ?, ?, ?)", [(k if k != 5 else None, k * 10, None if k % 4 == 0 else f"n{k}", f"2024-01-{k % 28 + 1:02d}" if k % 7 else None) for k in range(n * 50, n * 50 + 50)])
        paths.append(path)
    return paths


COLUMNS = "id long, total long, note string, at string"


def test_slices_of_a_database_hold_every_row_once(spark, shards):
    df = database.scan(spark, _open, shards, "select * from t", COLUMNS, "id", 4, chunk=7)
    assert df.rdd.getNumPartitions() == 8
    assert sorted(r.total for r in df.collect()) == [10 * k for k in range(100)]
    assert database.scan(spark, _open, shards, "select id, total from t where id < 0", "id long, total long", "id", 4).count() == 0
    assert [r.note for r in database.scan(spark, _open, shards[:1], "select note, id from t where id = 3", "note string").collect()] == ["n3"]


def test_a_cursor_of_a_database(spark, shards):
    got = database.scan(spark, _open, shards, "select * from t", COLUMNS, cursor="at", last="2024-01-20", end="2024-01-25")
    assert sorted(r.total // 10 for r in got.collect()) == sorted(k for k in range(100) if k % 7 == 0 or 20 <= k % 28 + 1 < 25)


def test_filters_go_to_the_database(spark, shards):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = database.scan(spark, _open, shards, "select * from t", COLUMNS, "id", 2).where("total >= 300 and note is not null and total < 600 and length(note) = 3")
        plan = df._jdf.queryExecution().toString()
        assert sorted(r.total // 10 for r in df.collect()) == [k for k in range(30, 60) if k % 4]
        assert "total >= 300" not in plan.split("== Physical Plan ==")[1].split("BatchScan")[0]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


# Texts and numbers


def _mail(depth, text="found", before=None):
    part = {"mimeType": "text/plain", "body": {"data": base64.urlsafe_b64encode(text.encode()).decode().rstrip("=")}}
    for _ in range(depth):
        part = {"mimeType": "multipart/mixed", "parts": [{"mimeType": "text/html", "body": {"data": "PGI-"}}, part]}
    if before:
        part["parts"].append({"mimeType": "text/plain", "body": {"data": base64.urlsafe_b64encode(before.encode()).decode()}})
    return json.dumps({"id": str(depth), "payload": part})


def test_a_text_is_found_at_any_depth(spark):
    rows = [(_mail(d),) for d in (0, 1, 5, 6, 7, 12, 40, 200)] + [(_mail(20, before="after it"),), ('{"id": "none", "payload": {"parts": []}}',), (None,), ("{",)]
    got = [r.body_text for r in records.mail_messages(spark.createDataFrame(rows, "raw string").coalesce(1), body_chars=100).collect()]
    assert got == ["found"] * 9 + [None] * 3


def test_decimals_keep_every_digit_or_none(spark):
    def cast(values, kind="string"):
        df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
        cell = mapping.compile_node(df, {"source": "v", "cast": "decimal"})
        return [(r[0], r[1] is None) for r in df.select(cell.value, cell.error, "k").orderBy("k").collect()]

    texts = ["1.00000000000000000019", "1.0000000000000000001", "1.000000000000000001", "1.0000000000000000010000", "12345678901234567890.5", "123456789012345678901234", "1e-18", "1e-19", "100e-20", "10e-20", "0e-30", "0.000000000000000000000", "-5E3", "500.", ".5"]
    got = cast(texts)
    want = [None, None, Decimal("1.000000000000000001"), Decimal("1.000000000000000001"), Decimal("12345678901234567890.5"), None, Decimal("1e-18"), None, Decimal("1e-18"), None, 0, 0, Decimal(-5000), Decimal(500), Decimal("0.5")]
    assert [v for v, _ in got] == want
    assert [ok for _, ok in got] == [w is not None for w in want]
    assert [v for v, _ in cast([Decimal("1.5"), Decimal("0.0000000000000000001")], "decimal(38,20)")] == [Decimal("1.5"), None]
    assert [v for v, _ in cast([0.1, 1e-20, 1e19], "double")] == [Decimal("0.1"), None, Decimal(10**19)]
    assert casts.value_of(F.lit(1), spark.range(1).schema["id"].dataType, "decimal")[1].scale == 18
