import base64
import json

import pytest

from fluvia.functions import records
from fluvia.operators import checks, feeds, land
from fluvia.sources import files


def _raw(spark, *entries):
    return spark.createDataFrame([(e if e is None else json.dumps(e),) for e in entries], "raw string")


def test_mail_takes_the_last_header_and_the_first_plain_text(spark):
    data = base64.urlsafe_b64encode("Grüße??>".encode()).decode().rstrip("=")
    nested = {"mimeType": "multipart/alternative", "parts": [{"mimeType": "text/plain", "body": {"data": "!"}}, {"mimeType": "text/plain", "body": {"data": data}}]}
    message = {"id": "m", "internalDate": "x", "payload": {"headers": [{"name": "From", "value": "a"}, {"name": "FROM", "value": "b"}], "parts": [nested]}}
    rows = records.mail_messages(_raw(spark, message, None, {}), body_chars=5).collect()
    assert [(r.id, r.from_address, r.internal_date, r.body_text) for r in rows] == [("m", "b", None, "Grüße"), (None, None, None, None), (None, None, None, None)]
    assert rows[0].label_ids == [] and rows[0].headers == {"from": "b"}


def test_drive_items(spark):
    items = _raw(
        spark,
        {"id": "1", "name": "f 1", "parentReference": {"path": "/drive/root:/A%20b+c/"}, "file": {"hashes": {"sha1Hash": "s"}}, "createdBy": {"application": {"displayName": "app"}}},
        {"id": "2", "folder": {}, "root": {}, "parentReference": {"path": "/x"}},
        {"id": "3", "deleted": {}},
    )
    one, two, three = records.drive_items(items, drive_id="d").collect()
    assert (one.path, one.content_hash, one.created_by, one.drive_id, one.is_folder) == ("/A b+c/f 1", "s", "app", "d", False)
    assert (two.path, two.is_folder, two.is_root, three.deleted) == ("/", True, True, True)
    assert [(r.id, r[land.DELETED]) for r in feeds.delta(records.drive_items(items), glob="*.pdf").collect()] == [("3", True)]


def test_labels_and_fields(spark):
    (row,) = records.mail_labels(_raw(spark, {"id": "L", "messagesTotal": 3})).collect()
    assert (row.id, row.messages_total, row.threads_unread) == ("L", 3, None)
    assert records.chosen_fields(["name", "ID", "Name"], "Stamp") == ["Id", "Stamp", "IsDeleted", "name"]


def test_scoped_feed(spark):
    folders = spark.createDataFrame([("R", "top"), ("Y", "R")], "id string, parent string")
    landed = spark.createDataFrame([("a", "R", "a.pdf"), ("b", "Y", "b.pdf")], "id string, parent string, name string")
    change = "id string, parent string, name string, is_folder boolean, gone boolean, seq int"
    run = lambda *cs: sorted((r.id, r[land.DELETED]) for r in feeds.scoped(spark, folders, landed, spark.createDataFrame(list(cs), change), "R", "*.pdf").collect())
    assert run(("n", "Y", "n.pdf", False, False, 1), ("x", "Q", "x.pdf", False, False, 1)) == [("n", False)]
    assert run(("a", "R", "a.txt", False, False, 1)) == [("a", True)]
    assert run(("Y", None, "Y", True, True, 1)) == [("b", True)]
    assert run(("a", "R", "a.pdf", False, True, 1), ("a", "R", "a.pdf", False, False, 2), ("z", "R", "z.pdf", False, True, 1)) == [("a", False)]
    assert run() == []


def test_files_by_folder_glob_and_name(spark, tmp_path):
    for i, name in enumerate(["exports/one.jsonl", "exports/two.jsonl", "exports/2024/three.jsonl", "exports/note.txt"], 1):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(json.dumps({"id": i}) + "\n")
    base = f"{tmp_path}/exports"
    ids = lambda path: sorted(r.id for r in files.records(spark, path, "jsonl", "id int").collect())
    assert (ids(f"{base}/*.jsonl"), ids(f"{base}/**/*.jsonl"), ids(f"{base}/two.jsonl")) == ([1, 2], [1, 2, 3], [2])
    assert sorted(r.name for r in files.listing(spark, base).collect()) == ["note.txt", "one.jsonl", "two.jsonl"]
    assert [r.name for r in files.listing(spark, f"{base}/**/*", "THREE").collect()] == ["three.jsonl"]
    with pytest.raises(ValueError):
        files.located("exports")


def test_declared_problems(spark):
    df = land.stamped(spark.createDataFrame([("1", "x")], "id string, v string"), "b", "r", "1")
    assert checks.resource_problems("merge") and checks.resource_problems("append", ["id"]) and not checks.resource_problems("merge", ["id"], "v", df.columns)
    errors, warnings = checks.projection_problems(df, {"k": {"source": "v"}, "z": {"source": "gone"}}, {"k": "bigint"}, ["k"], ["m"], ["id"], True)
    assert len(errors) == 4 and len(warnings) == 1
    assert checks.projection_problems(df, {"k": {"source": "id"}}, {"k": "string"}, ["k"], key=["id"], tombstones=True) == ([], [])
