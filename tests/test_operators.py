from pyspark.sql import functions as F

from fluvia.functions import mapping, redact
from fluvia.operators import land, project, shape


def test_tombstone_replaces_the_whole_row(spark):
    old = land.stamped(spark.createDataFrame([("1", "a", "x")], "id string, v string, extra string"), "b", "r1", "1")
    gone = land.stamped(spark.createDataFrame([("1", True)], f"id string, {land.DELETED} boolean"), "b", "r2", "2")
    (row,) = land.merged(old, gone, ["id"]).collect()
    assert (row.v, row.extra, row[land.DELETED], row[land.LOAD]) == (None, None, True, "2")


def test_null_keys_match_nothing(spark):
    old = spark.createDataFrame([(None, 1), ("a", 2)], "id string, v int")
    new = spark.createDataFrame([(None, 3), ("a", 4)], "id string, v int")
    assert sorted(r.v for r in land.merged(old, new, ["id"]).collect()) == [1, 3, 4]
    assert land.newest(old.unionAll(new), ["id"], [F.col("v")]).count() == 3


def test_empty_load_scope_selects_nothing(spark):
    df = land.stamped(spark.range(3), "b", "r", "1")
    assert land.in_loads(df, []).count() == 0 and land.in_loads(df, None).count() == 3 and land.in_loads(df, ["1"]).count() == 3


def test_all_empty_row_gives_every_stage(spark):
    df = spark.createDataFrame([("c1", "x", " "), ("c2", None, "")], "id string, a_at string, b_at string")
    got = sorted(tuple(r) for r in shape.unpivoted(df, shape.columns_like(df, "*_at"), ["id"]).collect())
    assert got == [("c1", "a_at", "x"), ("c2", "a_at", None), ("c2", "b_at", None)]


def test_casts_give_errors_as_values(spark):
    df = spark.createDataFrame([("£1,234.56", "3/4/2024", "1.0"), ("x", "2024", "7")], "d string, t string, i string")
    cells = mapping.compile_mapping(df, {
        "d": {"source": "d", "cast": "decimal", "strip": "£,"}, "t": {"source": "t", "cast": "date", "format": "%d/%m/%Y"}, "i": {"source": "i", "cast": "integer"},
    })
    rows = df.select(*[c.value.cast("string").alias(k) for k, c in cells.items()], *[c.error.isNull().alias(f"{k}_ok") for k, c in cells.items()]).collect()
    assert (float(rows[0].d), rows[0].t, rows[0].i, rows[0].i_ok) == (1234.56, "2024-04-03", None, False)
    assert (rows[1].d, rows[1].t, rows[1].i, rows[1].d_ok, rows[1].t_ok) == (None, None, "7", False, False)


def test_a_delete_wins_whatever_the_order(spark):
    df = spark.createDataFrame([("a", 1, False, "1", "x"), ("a", None, True, "2", "y"), ("a", 3, False, "3", "z"), ("b", 4, False, "1", "w")], f"id string, v int, {land.DELETED} boolean, {land.LOAD} string, {land.ROW} string")
    cells = mapping.compile_mapping(df, {"id": {"source": "id"}, "v": {"source": "v"}})
    got = {r.id: r.operation for r in project.collapsed(project.projected(df, cells, ["id"], ["v"]), ["id"]).select("values.id", "operation").collect()}
    assert got == {"a": "delete", "b": "upsert"}


def test_nulls_are_false_for_filters(spark):
    df = spark.createDataFrame([("a",), (None,)], "s string")
    for op, value in (("ne", "b"), ("not_in", []), ("eq", "a"), ("contains", "a")):
        assert df.where(mapping.condition(df, "s", op, value)).count() == 1
    assert df.where(mapping.condition(df, "s", "gt", 5)).count() == 0


def test_redaction(spark):
    df = spark.createDataFrame([("password=abc token: \"x y\" fine",), ("Bearer abc.def ok",)], "t string")
    assert [r[0] for r in df.select(redact.redacted(F.col("t"))).collect()] == ["password=*** token: *** fine", "Bearer *** ok"]
