"""Cursors and tokens, folds with what was fetched, stamps, JSON read back, previews and grades."""

import uuid

import pytest
from pyspark.sql import functions as F

from fluvia.functions import mapping
from fluvia.operators import checks, cursors, feeds, land, ledger
from fluvia.sources import versioned, workbook


def _table(spark, path, key=("id",)):
    root = f"file://{path}/{uuid.uuid4().hex}"
    versioned.create(spark, root, key, 4)
    return root


def test_a_cursor_moves_with_its_commit(spark, tmp_path, monkeypatch):
    root = _table(spark, tmp_path)
    frame = lambda *rows: spark.createDataFrame(list(rows), "id string, at int, v string")
    cursors.landed_since(frame(("a", 1, "old"), ("b", 2, "b"), ("a", 3, "NEW"), ("a", 2, "mid")), root, "1", "at", binding="b")
    assert cursors.last_value(spark, root, "int") == 3
    with monkeypatch.context() as m:
        m.setattr(versioned, "_committed", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            cursors.landed_since(frame(("c", 9, "c")), root, "2", "at", binding="b")
    assert cursors.last_value(spark, root, "int") == 3
    # The boundary row is read again, what lies before it is not, and a row without a cursor always is.
    cursors.landed_since(frame(("a", 3, "UPDATED"), ("b", 1, "late"), ("d", None, "none"), ("c", 4, "c")), root, "3", "at", binding="b")
    assert sorted((r.id, r.v) for r in versioned.table(spark, root).collect()) == [("a", "UPDATED"), ("b", "b"), ("c", "c"), ("d", "none")]
    assert cursors.last_value(spark, root, "int") == 4
    # Numbers are compared as numbers.
    cursors.landed_since(frame(("e", 9, "e"), ("f", 10, "f")), root, "4", "at", binding="b")
    assert cursors.last_value(spark, root, "int") == 10
    cursors.landed_since(frame(("e", 9, "again")), root, "5", "at", binding="b")
    assert versioned.table(spark, root).where("id = 'e'").first().v == "e"
    assert [(r.load_id, r.rows, r.high) for r in versioned.ledger(spark, root).orderBy("version").limit(2).collect()] == [("1", 2, "3"), ("3", 3, "4")]


def test_a_token_is_for_one_scope(spark):
    states = spark.createDataFrame([], "binding string, resource string, scope string, token string")
    states = cursors.with_token(states, "b", "files", {"folder": "R", "glob": "*.pdf"}, "t1")
    states = cursors.with_token(states, "b2", "files", {"folder": "R"}, "t2")
    assert cursors.token(states, "b", "files", {"glob": "*.pdf", "folder": "R"}) == "t1"
    assert cursors.token(states, "b", "files", {"folder": "R", "glob": "*"}) is None
    states = cursors.with_token(states, "b", "files", {"folder": "S"}, "t3")
    assert cursors.token(states, "b", "files", {"folder": "R", "glob": "*.pdf"}) is None and states.count() == 2


def test_what_vanished_before_it_was_fetched_is_a_tombstone(spark):
    changes = spark.createDataFrame([("m1", "added"), ("m1", "labels"), ("m2", "added"), ("m2", "deleted"), ("m3", "added"), ("m4", "deleted"), (None, "added")], "id string, kind string")
    fetched = spark.createDataFrame([("m1", "subject 1", 5), ("m2", "was there", 6), ("m9", "not asked for", 1)], "id string, subject string, size int")
    got = feeds.fetched_changes(changes, fetched, "id", F.col("kind") == "deleted").orderBy("id").collect()
    assert [tuple(r) for r in got] == [("m1", "subject 1", 5, False), ("m2", None, None, True), ("m3", None, None, True), ("m4", None, None, True)]
    assert feeds.fetched_changes(changes.limit(0), fetched, "id", F.col("kind") == "deleted").count() == 0


def test_a_row_without_a_stamp_stops_the_load(spark, tmp_path):
    root = _table(spark, tmp_path)
    good = land.stamped(spark.createDataFrame([("a",), ("b",)], "id string"), "b1", "r1", "1")
    bad = good.withColumn(land.BINDING, F.when(F.col("id") == "a", F.col(land.BINDING)))
    with pytest.raises(Exception, match="a row of load 1 has no _connector_binding_id"):
        versioned.merge(bad, root, "1")
    assert versioned.current(spark, root).number == 0
    assert versioned.merge(good, root, "1").number == 1


def test_nested_columns_come_back(spark, tmp_path):
    df = spark.sql("select 'a' id, array(1, 2) tags, named_struct('k', 1.5D, 'l', 'x') meta, map('p', 1) m, 'plain' t union all select 'b', null, null, null, null")
    landed = land.nested_to_json(df)
    assert [f.dataType.simpleString() for f in landed.schema] == ["string"] * 5
    assert landed.where("id = 'a'").first().tags == "[1,2]"
    root = _table(spark, tmp_path)
    versioned.merge(landed, root, "1")
    back = land.decoded(versioned.table(spark, root))
    row = back.where("id = 'a'").first()
    assert row.tags == [1, 2] and row.meta.asDict() == {"k": 1.5, "l": "x"} and row.m == {"p": 1} and row.t == "plain" and row.tags__v_string is None
    assert back.where("id = 'b'").first().tags is None


def _landed(spark, n=30):
    rows = spark.range(n).select(F.col("id"), F.when(F.col("id") % 5 == 0, "x").otherwise(F.col("id").cast("string")).alias("word"))
    return land.stamped(rows, "b", "r", "1").withColumn(land.ROW, F.lpad(F.col("id").cast("string"), 4, "0"))


def test_a_preview_ends_with_its_budget(spark):
    landed = _landed(spark).repartition(3)
    cells = mapping.compile_mapping(landed, {"id": {"source": "id"}, "n": {"source": "word", "cast": "integer"}})
    keep = mapping.all_of(landed, [{"field": "id", "op": "ne", "value": 1}])
    shown = checks.preview(landed, cells, ["id"], filters=keep, limit=12)
    assert sorted(r.source.id for r in shown.collect()) == list(range(12)) and not any(r.truncated for r in shown.collect())
    assert checks.preview_counts(shown) == {"row_count": 12, "ok_count": 8, "filtered_count": 1, "error_count": 3}
    first = checks.preview(landed, cells, ["id"], limit=12, most_bytes=250).collect()
    assert 1 <= len(first) < 5 and [r.truncated for r in sorted(first, key=lambda r: r.source.id)] == [False] * (len(first) - 1) + [True]
    assert [tuple(r.source) for r in checks.preview(landed, cells, ["id"], limit=1).collect()] == [(0, "x")]
    assert checks.preview(landed, cells, ["id"], limit=5000).count() == 30 and checks.preview(landed, cells, ["id"], limit=None).count() == 30


def test_projections_are_graded_anew(spark):
    df = spark.createDataFrame([], "id string, amount bigint, amount__v_string string, at string")
    fields = {"external_id": "string", "amount": "bigint"}
    p = {"nodes": {"external_id": {"source": "id"}}, "fields": fields, "identity": ["external_id"]}
    gone = p | {"nodes": {"external_id": {"source": "gone_away"}}}
    split = p | {"nodes": p["nodes"] | {"amount": {"source": "amount"}}}
    filtered = p | {"filters": [{"field": "nothing", "op": "eq", "value": 1}]}
    graded = checks.regraded(df, {"fine": p | {"status": "invalid"}, "gone": gone, "split": split, "filtered": filtered, "draft": gone | {"status": "draft"}})
    assert {k: v[0] for k, v in graded.items()} == {"fine": "active", "gone": "invalid", "split": "needs_review", "filtered": "invalid", "draft": "draft"}
    assert "gone_away" in graded["gone"][1][0] and "amount" in graded["split"][1][0] and "nothing" in graded["filtered"][1][0]


def test_held_loads_by_run_or_by_load(spark):
    landed = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "load_id string")
    by_load = spark.createDataFrame([("succeeded", "1"), ("failed", "2"), ("running", "3")], "status string, load_id string")
    by_run = spark.createDataFrame([("succeeded", ["1"]), ("failed", ["2"]), ("running", ["3"])], "status string, load_ids array<string>")
    for runs in (by_load, by_run):
        assert sorted(r.load_id for r in ledger.outstanding(landed, runs).collect()) == ["2", "4"]


def test_json_is_one_value(spark):
    texts = ['{"k": 1}', "1", '"x"', "null", "[1, 2]", ' {"a": []} ', '{"k": 1}}', "1]", "1, 2", '1, "b": 2', "", " ", "{", "1],[2", "x", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    cell = mapping.compile_node(df, {"source": "t", "cast": "json"})
    got = [(r[0], r[1] is None) for r in df.select(cell.value, cell.error, "k").orderBy("k").collect()]
    assert got == [(t, True) for t in texts[:6]] + [(None, False)] * 9 + [(None, True)]


def test_formats_that_show_dates():
    dates = ["m/d/yyyy", "yyyy-mm-dd hh:mm", "[h]:mm", "dd\\-mmm", "[$-409]d. mmm", "h:mm AM/PM", '"due" d']
    others = ["General", "0.00", "#,##0", "0%", '"days" 0', "[Red]0.00", "0.00E+00", "@", '0;"dmy"', "\\d0", "_d0", "$#,##0.00"]
    assert [c for c in dates if not workbook.shows_date(c)] == [] and [c for c in others if workbook.shows_date(c)] == []
    assert workbook.date_text("45358.395833333336") == "2024-03-07 09:30:00"
    assert [workbook.date_text(n) for n in ("1", "59", "61", "0.5", "x", "1e99")] == ["1900-01-01 00:00:00", "1900-02-28 00:00:00", "1900-03-01 00:00:00", "12:00:00", "x", "1e99"]
    assert workbook.date_text("0", True) == "00:00:00" and workbook.date_text("1", True) == "1904-01-02 00:00:00"
    # A number without a date's style stays one.
    (row,) = [r for r in workbook.sheets(workbook.packed([["45358", None, "x"]])) if r[3]]
    assert row[3] == ["45358", None, "x"]
