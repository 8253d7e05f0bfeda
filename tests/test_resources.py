"""Resources landed table by table, appends, compaction, histories, purges and parsed deliveries."""

import pytest
from pyspark.sql import functions as F

from fluvia.operators import land, resources
from fluvia.operators.resources import Resource
from fluvia.sources import versioned
from fluvia.streaming import deliveries, landing


def _frame(spark, rows, schema="id string, v int"):
    return spark.createDataFrame(rows, schema)


def _land(spark, path, load, declared, key="k1", **how):
    return resources.land_source(spark, f"file://{path}", "shop", key, declared, "b", "r", load, buckets=4, **how)


def _rows(spark, path, name, *columns, key="k1"):
    table = versioned.table(spark, resources.root_of(f"file://{path}", "shop", name, key))
    return sorted((tuple(r) for r in table.select(*(columns or ("id", "v"))).collect()), key=str)


def test_dispositions(spark, tmp_path):
    merged, added, anew = (lambda df: Resource(df, ["id"])), (lambda df: Resource(df, disposition="append")), (lambda df: resources.of_sheet(df))
    for load, rows in (("1", [("a", 1), ("b", 1), ("b", 1)]), ("2", [("b", 2), (None, 2), (None, 2)]), ("2", [("z", 9)])):
        df = _frame(spark, rows)
        _land(spark, tmp_path, load, {"m": merged(df), "a": added(df), "r": anew(df)})
    # Rows without a key are never one another's copies.
    assert _rows(spark, tmp_path, "m") == sorted([("a", 1), ("b", 2), (None, 2), (None, 2)], key=str)
    assert _rows(spark, tmp_path, "a") == sorted([("a", 1), ("b", 1), ("b", 1), ("b", 2), (None, 2), (None, 2)], key=str)
    assert _rows(spark, tmp_path, "r") == sorted([("b", 2), (None, 2), (None, 2)], key=str)
    assert len(set(_rows(spark, tmp_path, "a", land.ROW))) == 6
    _land(spark, tmp_path, "3", {"r": anew(_frame(spark, []))})
    assert _rows(spark, tmp_path, "r") == []


def test_of_a_load_the_newest_row_of_a_key_stays(spark, tmp_path):
    df = _frame(spark, [("a", 1), ("a", 3), ("a", None), ("a", 2)])
    _land(spark, tmp_path, "1", {"m": Resource(df, ["id"], cursor="v")})
    assert _rows(spark, tmp_path, "m") == [("a", 3)]


def test_what_is_declared_wrong_writes_nothing(spark, tmp_path):
    df = _frame(spark, [("a", 1)])
    wrong = {"good": Resource(df, ["id"]), "keyless": Resource(df), "keyed": Resource(df, ["id"], "append"), "odd": Resource(df, ["id"], "upsert"), "lost": Resource(df, ["nothing"], cursor="never")}
    with pytest.raises(ValueError) as e:
        _land(spark, tmp_path, "1", wrong)
    for said in ("keyless: a merge needs a key", "keyed: an append takes no key", "odd: unknown disposition", "no column 'nothing'", "no column 'never'"):
        assert said in str(e.value)
    assert "good" not in str(e.value) and versioned.folders(spark, f"file://{tmp_path}") == []
    with pytest.raises(ValueError, match="no resource 'other'"):
        _land(spark, tmp_path, "1", wrong, only=["other"])
    _land(spark, tmp_path, "1", wrong, only=["good"])
    assert versioned.folders(spark, f"file://{tmp_path}") == ["shop_good_k1"]
    with pytest.raises(ValueError, match="its table goes by id"):
        _land(spark, tmp_path, "2", {"good": Resource(df, ["v"])})
    with pytest.raises(ValueError, match="more than 63"):
        _land(spark, tmp_path, "2", {"x" * 60: Resource(df, ["id"])})


def test_columns_by_their_stable_names(spark):
    df = spark.sql("select 1 OrderId, 'x' `last-name`, 2 `3rd`, 4 `tail_`, array(1) Tags, named_struct('In', 1) meta, true _connector_deleted")
    out = resources.shaped(df)
    assert out.columns == ["order_id", "last_name", "_3rd", "tailx", "tags", "meta", land.DELETED]
    assert out.first().meta == '{"In":1}' and land.decoded(out).first().tags == [1]
    with pytest.raises(ValueError, match="order_id from 'OrderId', 'order-id'"):
        resources.shaped(spark.sql("select 1 OrderId, 2 `order-id`"))


def test_a_load_that_stopped_between_two_tables_goes_on(spark, tmp_path, monkeypatch):
    df = _frame(spark, [("a", 1)])
    declared = {"one": Resource(df, disposition="append"), "two": Resource(df, ["id"])}
    real = versioned._committed

    def lost(session, root, version):
        if "two" in root and version.load:
            raise RuntimeError("lost")
        return real(session, root, version)

    with monkeypatch.context() as m:
        m.setattr(versioned, "_committed", lost)
        with pytest.raises(RuntimeError, match="lost"):
            _land(spark, tmp_path, "1", declared)
    _land(spark, tmp_path, "1", declared)
    assert _rows(spark, tmp_path, "one") == [("a", 1)] and _rows(spark, tmp_path, "two") == [("a", 1)]


def _append_root(spark, path, buckets=2):
    root = f"file://{path}/log"
    versioned.create(spark, root, [land.ROW], buckets)
    return root


def _stamped(spark, rows, load, schema="id string, v int"):
    return land.stamped(_frame(spark, rows, schema), "b", "r", load)


def test_appends_at_once_and_compaction(spark, tmp_path, monkeypatch):
    """The other writer commits between what this one read and its own commit, once while it appends and once while it compacts."""
    root = _append_root(spark, tmp_path)
    versioned.append(_stamped(spark, [("a", k) for k in range(20)], "1"), root, "1")
    first = versioned.current(spark, root).files
    real, between = versioned._committed, []

    def late(session, where, version):
        if between:
            load, rows, schema = between.pop()
            versioned.append(_stamped(spark, rows, load, schema), root, load)
        return real(session, where, version)

    monkeypatch.setattr(versioned, "_committed", late)
    between.append(("3", [("c", k) for k in range(20)], "id string, v int"))
    versioned.append(_stamped(spark, [("b", k) for k in range(20)], "2"), root, "2")
    after = versioned.current(spark, root)
    # Nothing that was there is written again.
    assert all(after.files[b][: len(f)] == f for b, f in first.items()) and max(map(len, after.files.values())) == 3
    between.append(("4", [("d", k) for k in range(20)], "id string, v int"))
    done = versioned.compact(spark, root, 2)
    assert max(map(len, done.files.values())) == 2
    counts = versioned.table(spark, root).groupBy("id", land.LOAD).count().collect()
    assert sorted(map(tuple, counts)) == [("a", "1", 20), ("b", "2", 20), ("c", "3", 20), ("d", "4", 20)]
    assert sorted(r.load_id for r in versioned.ledger(spark, root).collect()) == ["1", "2", "3", "4"]
    assert versioned.compact(spark, root, 2).number == done.number


def test_a_bucket_that_was_merged_meanwhile_is_not_compacted(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/t"
    versioned.create(spark, root, ["id"], 1)
    for n in range(3):
        versioned.merge(_frame(spark, [(str(n), n)]), root, str(n), append=True)
    real, between = versioned._committed, [1]

    def late(session, where, version):
        if between and not version.load:
            between.pop()
            versioned.merge(_frame(spark, [("1", 7)]), root, "late")
        return real(session, where, version)

    monkeypatch.setattr(versioned, "_committed", late)
    versioned.compact(spark, root, 1)
    assert sorted(tuple(r) for r in versioned.table(spark, root).collect()) == [("0", 0), ("1", 7), ("2", 2)]


def test_appended_columns_come_and_change(spark, tmp_path):
    root = _append_root(spark, tmp_path)
    versioned.append(_stamped(spark, [("a", 1)], "1"), root, "1")
    versioned.append(_stamped(spark, [("a", 1, "n")], "2", "id string, v int, note string"), root, "2")
    versioned.append(_stamped(spark, [("a", "x"), ("a", "5")], "3", "id string, v string"), root, "3")
    got = versioned.table(spark, root).select("id", "v", "note", "v__v_string").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([("a", 1, None, None), ("a", 1, "n", None), ("a", None, None, "x"), ("a", 5, None, None)], key=str)
    told = versioned.history(spark, root)
    assert [(n, load) for n, load, _ in told] == [(1, "1"), (2, "2"), (3, "3")] and "note" in told[1][2].names and "note" not in told[0][2].names
    with pytest.raises(ValueError, match="takes nothing out"):
        versioned.merge(_stamped(spark, [("a", 1)], "4"), root, "4", whole=True, append=True)
    with pytest.raises(ValueError, match="stamps"):
        versioned.append(_frame(spark, [("a", 1)]), root, "4")
    with pytest.raises(Exception, match="has no _row_id"):
        versioned.append(_stamped(spark, [("a", 1)], "4").withColumn(land.ROW, F.lit(None).cast("string")), root, "4")


def test_a_load_is_written_once_where_nothing_is_taken_out(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    versioned.create(spark, root, ["id"], 4)
    versioned.merge(_frame(spark, [(str(k), k) for k in range(50)]), root, "1")
    assert len(versioned.folders(spark, f"{root}/data")) == 1
    versioned.merge(_frame(spark, [("7", -7)]), root, "2")
    assert len(versioned.folders(spark, f"{root}/data")) == 3
    assert versioned.table(spark, root).where("id = '7'").first().v == -7 and versioned.table(spark, root).columns == ["id", "v"]


def test_schemas_fingerprints_and_purge(spark, tmp_path):
    base, names = f"file://{tmp_path}", ["one", "two"]
    of = lambda key="k1": resources.landed_schema(spark, base, "shop", key, names)
    assert of() == {"status": "pending_first_run", "resources": {}, "fingerprint": ""}
    one = {"one": Resource(_frame(spark, [("a", 1)]), ["id"])}
    _land(spark, tmp_path, "1", one)
    _land(spark, tmp_path, "1", one | {"old": Resource(_frame(spark, [("a", 1)]), ["id"])}, key="k2")
    before = of()
    assert before["status"] == "ready" and list(before["resources"]) == ["one"] and before["resources"]["one"]["table"] == "shop_one_k1"
    assert [(c["name"], c["type"], c["variant_of"]) for c in before["resources"]["one"]["columns"]] == [("id", "string", None), ("v", "int", None)]
    _land(spark, tmp_path, "2", one)
    assert of()["fingerprint"] == before["fingerprint"] == of("k2")["fingerprint"]
    _land(spark, tmp_path, "3", {"one": Resource(_frame(spark, [("b", "x")], "id string, v string"), ["id"])})
    assert of()["fingerprint"] != before["fingerprint"]
    table = versioned.table(spark, f"{base}/shop_one_k1")
    assert resources.variant_counts(table) == {"v__v_string": 1} and resources.variant_counts(table.select("id")) == {}
    # What is no longer declared goes too, what is another binding's stays.
    assert resources.purge(spark, base, "shop", "k2", ["one", "two"]) == ["shop_old_k2", "shop_one_k2"]
    assert versioned.folders(spark, base) == ["shop_one_k1"] and of("k2")["status"] == "pending_first_run"
    assert resources.purge(spark, base, "shop", "k2", ["one"]) == []


def test_projections_are_graded_with_every_change(spark, tmp_path):
    root = f"file://{tmp_path}/shop_m_k1"
    for load, rows, schema in (("1", [("a", 1)], "id string, v int"), ("2", [("b", 2)], "id string, v int"), ("3", [("c", "x")], "id string, v string")):
        _land(spark, tmp_path, load, {"m": Resource(_frame(spark, rows, schema), ["id"])})
    p = {"nodes": {"k": {"source": "id"}, "n": {"source": "v"}}, "fields": {"k": "string", "n": "int"}, "identity": ["k"]}
    told = resources.regraded(spark, root, {"p": p})
    assert [(n, load, of["p"][0]) for n, load, of in told] == [(1, "1", "active"), (3, "3", "needs_review")]


def test_parsed_deliveries(spark):
    df = spark.createDataFrame([("d1", ["a", "b", "a", None], "x"), ("", None, "x"), (None, [], ""), (None, None, None)], "given string, ids array<string>, body string")
    got = deliveries.parsed(df, F.col("given"), F.col("ids")).collect()
    assert [r.external_ids for r in got] == [["a", "b"], [], [], []]
    assert got[0].fingerprint[:2] == "d:" and got[1].fingerprint[:2] == "b:" and got[2].fingerprint is None and got[3].fingerprint is None
    plain = deliveries.parsed(df).collect()
    assert plain[0].fingerprint == plain[1].fingerprint == got[1].fingerprint and plain[0].external_ids == []


def test_a_stream_is_appended_once_and_compacted(spark, tmp_path, monkeypatch):
    schema, root = "id string, v int", f"file://{tmp_path}/out/table"
    run = lambda: landing.appended(landing.files(spark, f"{tmp_path}/in", schema, 1), f"file://{tmp_path}/out", "b", "r", buckets=1, most=2)
    (tmp_path / "in").mkdir()
    assert run().count() == 0
    for _ in range(4):
        _frame(spark, [("a", 1), ("a", 1), (None, None)]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    with monkeypatch.context() as m:
        # The batch is committed and the stream stops before it knows.
        m.setattr(versioned, "compact", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            run()
    assert versioned.table(spark, root).count() == 3
    rows = run()
    assert rows.count() == 12 and rows.select(land.ROW).distinct().count() == 12 and rows.where("id is null").count() == 4
    assert max(map(len, versioned.current(spark, root).files.values())) <= 2
    assert run().count() == 12
