import io
import uuid
import zipfile

import pytest
from pyspark.sql import functions as F

from fluvia.functions import names
from fluvia.operators import grid, land
from fluvia.sources import files, jdbc, tables, workbook
from fluvia.streaming import landing


def test_listing_and_globs(spark, tmp_path):
    for name, ids in (("exports/one", "1"), ("exports/two", "2"), ("exports/2024/three", "3")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / f"{name}.jsonl").write_text(f'{{"id": "{ids}"}}\n')
    read = lambda path: sorted(r.id for r in files.records(spark, f"{tmp_path}/{path}", "jsonl", "id string").collect())
    assert (read("exports"), read("exports/**/*.jsonl"), read("exports/one.jsonl")) == (["1", "2"], ["1", "2", "3"], ["1"])
    assert [r.name for r in files.listing(spark, f"{tmp_path}/exports/**/*.jsonl", contains="THR").collect()] == ["three.jsonl"]
    with pytest.raises(ValueError):
        files.located("exports/one")


def _awkward(path):
    """A sheet with blank, doubled and shared headers, a gap, a merged block, and a hidden sheet beside it."""
    data = workbook.packed([["Region", None, "id", "id", "Total", None], ["north", "x", "1", None, " 7 "], [None, None, "2"], [], ["south", "", "3"], [None, None, None, None, "  "]], merges=("A2:B3",))
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(data)) as old, zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            text = old.read(name).decode()
            text = text.replace("</sheets>", '<sheet name="Scratch" sheetId="2" state="hidden" r:id="rId1"/></sheets>')
            new.writestr(name, text.replace('<c r="C2" t="inlineStr"><is><t xml:space="preserve">1</t></is></c>', '<c r="C2" t="s"><v>1</v></c>'))
        new.writestr("xl/sharedStrings.xml", f'<sst xmlns="{workbook.MAIN[1:-1]}"><si><t>no</t></si><si><r><t>o</t></r><r><t>ne</t></r></si></sst>')
    path.write_bytes(out.getvalue())


def test_workbook(spark, tmp_path):
    _awkward(tmp_path / "a.xlsx")
    (tmp_path / "~$a.xlsx").write_bytes(b"lock")
    (tmp_path / "a.txt").write_bytes(b"text")
    assert {r.sheet for r in workbook.scan(spark, f"file://{tmp_path}", hidden=True).collect()} == {"Data", "Scratch"}
    assert {r.sheet for r in workbook.scan(spark, f"file://{tmp_path}", chosen=["Scratch"]).collect()} == {"Scratch"}
    with pytest.raises(Exception, match="no worksheet named"):
        workbook.scan(spark, f"file://{tmp_path}", chosen=["Data", "Gone"]).collect()
    rows = workbook.scan(spark, f"file://{tmp_path}")
    (region,) = workbook.regions(rows).collect()
    assert tuple(region)[1:] == (2, 1, 3, 2)
    cells = grid.filled(workbook.grid(rows), workbook.regions(rows))
    got = {r.sheet_row_number: r.record for r in grid.records(cells).collect()}
    head = ["region", "column_2", "id", "id_2", "total"]
    assert {k: [r[h] for h in head] for k, r in got.items()} == {2: ["north", "north", "one", None, "7"], 3: ["north", "north", "2", None, None], 5: ["south", None, "3", None, None]}
    assert grid.keyed(grid.records(cells), "total", "skip").count() == 1
    with pytest.raises(ValueError, match="row 3"):
        grid.keyed(grid.records(cells), "total")
    assert grid.records(cells, skip_rows=2).count() == 1 and grid.records(cells, header_row=None).count() == 4
    assert grid.records(cells.limit(0)).count() == 0


def test_headers_never_collide(spark):
    df = spark.createDataFrame([(["ID", "id", "id_2", " ", "Sheet Row Number", None],)], "h array<string>")
    assert df.select(grid.header_names(F.col("h"))).first()[0] == ["id", "id_2", "id_2_2", "column_4", "sheet_row_number_2", "column_6"]


def test_database(spark):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    rows = [(1, "a", 10), (2, "b", 20), (3, None, None), (4, "d", 40)]
    spark.createDataFrame(rows, "ID int, NOTE string, MOMENT int").write.format("jdbc").options(url=url, dbtable="orders").save()
    assert jdbc.scan(spark, url, jdbc.selected(table="orders")).count() == 4
    query = "select id, moment from orders"
    assert jdbc.scan(spark, url, jdbc.selected(query)).columns == ["ID", "MOMENT"]
    later = jdbc.scan(spark, url, jdbc.selected(query, cursor="moment", last="20"), slices=("ID", 1, 5, 2))
    assert sorted(r.ID for r in later.collect()) == [2, 3, 4]
    assert sorted(r.ID for r in jdbc.scan(spark, url, jdbc.selected(query, cursor="moment", last="10", end="40")).collect()) == [1, 2, 3]
    with pytest.raises(ValueError):
        jdbc.selected(query, table="orders")


def test_sinks(spark):
    table = f"t_{uuid.uuid4().hex}"
    df = spark.createDataFrame([("1", 1), ("2", 2)], "id string, v int")
    tables.merge(df, table, ["id"])
    tables.merge(spark.createDataFrame([("2", 5, "x"), (None, 6, "y")], "id string, v int, w string"), table, ["id"])
    assert sorted((r.id or "", r.v, r.w) for r in spark.table(table).collect()) == [("", 6, "y"), ("1", 1, None), ("2", 5, "x")]
    with pytest.raises(ValueError):
        tables.append(df, table, ["id"])
    tables.replace(df.limit(0), table)
    assert spark.table(table).count() == 0
    tables.purge(spark, [table])
    assert not spark.catalog.tableExists(table)


def test_names(spark):
    assert [names.identifier(n) for n in ("Order ID", "2nd-Try", "HTTPCode__x", "a_")] == ["order_id", "_2nd_try", "http_code_x", "ax"]
    was = spark.createDataFrame([(1, 2)], "a int, b int")
    assert names.drift(was, was.drop("b"), ["a", "b"]) == ("invalid", ["b"])
    assert names.drift(was, land.evolved(was, was.withColumn("b", F.lit("x")))[1], ["b"]) == ("needs_review", ["b__v_string"])
    assert names.fingerprint(was) == names.fingerprint(was.select("b", "a")) != names.fingerprint(was.drop("a"))
    df = spark.createDataFrame([("2024-03-01T10:00:00.999+0000",), ("2024-03-01T12:30:00+0230",), (None,)], "t string")
    assert [r[0] for r in df.select(names.cursor_literal(F.col("t"))).collect()] == ["2024-03-01T10:00:00Z", "2024-03-01T10:00:00Z", None]


def test_landing_stream_goes_on_where_it_stopped(spark, tmp_path):
    schema, run = "id string, at int, v string", lambda n: landing.landed(landing.files(spark, f"{tmp_path}/in", schema), f"file://{tmp_path}/out", ["id"], [F.col("at")], "b1", n)
    land_more = lambda *rows: spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    land_more(("a", 1, "old"), ("b", 1, "b"), ("a", 1, "old"))
    assert sorted((r.id, r.v) for r in run("1").collect()) == [("a", "old"), ("b", "b")]
    land_more(("a", 1, "boundary"))
    assert sorted((r.id, r.v, r[land.LOAD]) for r in run("2").collect()) == [("a", "boundary", "2"), ("b", "b", "1")]
    assert run("3").count() == 2
