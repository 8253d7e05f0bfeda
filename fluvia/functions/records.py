"""Provider records, as JSON text, flattened to typed columns.

Each function takes a frame with a JSON column and returns one row for each of
its rows.  A null or malformed text gives nulls; an empty table no rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.land import DELETED

# Media types of folders and of documents that the provider keeps itself.
FOLDER_MIME, NATIVE_PREFIX = "application/vnd.google-apps.folder", "application/vnd.google-apps."
# Lifted mail headers and the columns that they go to.
HEADERS = {"subject": "subject", "from": "from_address", "to": "to_addresses", "cc": "cc_addresses", "date": "sent_at_header", "message-id": "rfc822_message_id"}
#: Levels of nested message parts that Spark's own expressions look through; what lies deeper is walked by a function.
PART_DEPTH = 6

_DRIVE = "id string, name string, mimeType string, size string, md5Checksum string, parents array<string>, driveId string, version string, webViewLink string, createdTime string, modifiedTime string"
_WHO = "struct<user struct<displayName string>, application struct<displayName string>, device struct<displayName string>>"
_GRAPH = (
    "id string, name string, size bigint, folder string, root string, deleted string, eTag string, cTag string, webUrl string, createdDateTime string, lastModifiedDateTime string, "
    "file struct<mimeType string, hashes struct<quickXorHash string, sha256Hash string, sha1Hash string>>, "
    f"parentReference struct<id string, driveId string, path string>, createdBy {_WHO}, lastModifiedBy {_WHO}"
)
_LABEL = {
    "id": "string", "name": "string", "type": "string", "messageListVisibility": "string", "labelListVisibility": "string",
    "messagesTotal": "bigint", "messagesUnread": "bigint", "threadsTotal": "bigint", "threadsUnread": "bigint",
}


def _snake(name: str) -> str:
    return "".join("_" + c.lower() if c.isupper() else c for c in name)


def _filled(value: Column) -> Column:
    """Null where the text is empty."""
    return F.nullif(value, F.lit(""))


def drive_files(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Thirteen columns of a drive's file; a size that is no number is null."""
    r = F.from_json(F.col(raw), _DRIVE)
    mime = F.coalesce(r["mimeType"], F.lit(""))
    return df.select(
        r["id"].alias("id"), r["name"].alias("name"), mime.alias("mime_type"), (mime == FOLDER_MIME).alias("is_folder"), mime.startswith(NATIVE_PREFIX).alias("is_native"),
        r["size"].try_cast("bigint").alias("size"), r["md5Checksum"].alias("md5"), F.get(r["parents"], 0).alias("parent_id"), r["driveId"].alias("drive_id"), r["version"].alias("version"),
        r["webViewLink"].alias("web_url"), r["createdTime"].alias("created_at"), r["modifiedTime"].alias("modified_at"),
    )


def _who(identity: Column) -> Column:
    return F.coalesce(*[_filled(identity[slot]["displayName"]) for slot in ("user", "application", "device")])


def drive_items(df: DataFrame, raw: str = "raw", drive_id: str | None = None) -> DataFrame:
    """Sixteen columns of an item, with ``is_root`` and ``deleted`` for the delta fold."""
    r = F.from_json(F.col(raw), _GRAPH)
    hashes, parent = r["file"]["hashes"], r["parentReference"]
    tail = F.regexp_extract(F.coalesce(parent["path"], F.lit("")), "(?s)root:(.*)$", 1)
    # A plus sign is itself in a path; a path that doesn't decode stays as it is.
    folder = F.coalesce(F.try_url_decode(F.replace(tail, F.lit("+"), F.lit("%2B"))), tail)
    name = _filled(r["name"])
    path = F.when(name.isNull(), F.coalesce(_filled(folder), F.lit("/"))).otherwise(F.concat(F.regexp_replace(folder, "/+$", ""), F.lit("/"), name))
    return df.select(
        r["id"].alias("id"), r["name"].alias("name"), path.alias("path"), parent["id"].alias("parent_id"), F.coalesce(_filled(parent["driveId"]), F.lit(drive_id).cast("string")).alias("drive_id"),
        r["folder"].isNotNull().alias("is_folder"), r["size"].alias("size"), r["file"]["mimeType"].alias("mime_type"),
        F.coalesce(*[_filled(hashes[h]) for h in ("quickXorHash", "sha256Hash", "sha1Hash")]).alias("content_hash"),
        r["eTag"].alias("etag"), r["cTag"].alias("ctag"), r["webUrl"].alias("web_url"), r["createdDateTime"].alias("created_at"), r["lastModifiedDateTime"].alias("last_modified_at"),
        _who(r["createdBy"]).alias("created_by"), _who(r["lastModifiedBy"]).alias("last_modified_by"), r["root"].isNotNull().alias("is_root"), r["deleted"].isNotNull().alias("deleted"),
    )


def _part_schema(depth: int) -> str:
    """The lowest level's parts stay JSON."""
    below = f"array<{_part_schema(depth - 1)}>" if depth > 1 else "string"
    return f"struct<mimeType: string, body: struct<data: string>, parts: {below}>"


def _decoded(data: Column) -> Column:
    """URL-safe base64, with or without padding, as text; null where it doesn't decode."""
    plain = F.regexp_replace(F.translate(data, "-_", "+/"), "=+$", "")
    padded = F.concat(plain, F.repeat(F.lit("="), F.pmod(-F.length(plain), F.lit(4))))
    return F.make_valid_utf8(F.try_to_binary(_filled(padded), F.lit("base64")).cast("string"))


def _plain_texts(part: Column, depth: int) -> Column:
    """(text, deeper) of a part and of those below it, depth first: its plain text, and whether it has parts that are still JSON."""
    text = F.when(part["mimeType"] == "text/plain", _decoded(part["body"]["data"]))
    deeper = part["parts"].isNotNull() if depth == 1 else F.lit(False)
    own = F.array(F.struct(text.alias("text"), F.coalesce(deeper, F.lit(False)).alias("deeper")))
    if depth == 1:
        return own
    below = F.flatten(F.transform(F.coalesce(part["parts"], F.array().cast(f"array<{_part_schema(depth - 1)}>")), lambda p: _plain_texts(p, depth - 1)))
    return F.concat(own, below)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _plain_data(raw: pd.Series) -> pd.Series:
    """The coded plain texts of a message of any depth, depth first; null for a null."""

    def found(text: str | None) -> list[str] | None:
        if text is None:
            return None
        out, waiting = [], [json.loads(text).get("payload")]
        while waiting:
            part = waiting.pop()
            if not isinstance(part, dict):
                continue
            body, parts = part.get("body"), part.get("parts")
            if part.get("mimeType") == "text/plain" and isinstance(body, dict) and isinstance(body.get("data"), str):
                out.append(body["data"])
            waiting += reversed(parts) if isinstance(parts, list) else []
        return out

    return raw.map(found)


def _body_text(raw: str) -> Column:
    """The first plain text of a message.  Messages with nothing before their deep parts go to the function, the others' JSON does not."""
    part = F.from_json(F.col(raw), f"payload {_part_schema(PART_DEPTH)}")["payload"]
    first = F.get(F.filter(_plain_texts(part, PART_DEPTH), lambda t: t["text"].isNotNull() | t["deeper"]), 0)
    deep = F.filter(F.transform(_plain_data(F.when(first["deeper"] & first["text"].isNull(), F.col(raw))), _decoded), lambda t: t.isNotNull())
    return F.coalesce(first["text"], F.get(deep, 0))


def mail_messages(df: DataFrame, raw: str = "raw", body_chars: int | None = None) -> DataFrame:
    """A message's columns; of headers of one name (in any case) the last counts.  ``body_chars``: adds the first plain text, cut there."""
    head = "id string, threadId string, historyId string, labelIds array<string>, snippet string, sizeEstimate bigint, internalDate string, payload struct<headers: array<struct<name: string, value: string>>>"
    r = F.from_json(F.col(raw), head)
    named = F.transform(F.filter(r["payload"]["headers"], lambda h: F.length(h["name"]) > 0), lambda h: F.struct(F.lower(h["name"]).alias("key"), h["value"].alias("value")))
    rows = df.select("*", r.alias("_r"), named.alias("_named"))
    last = F.filter("_named", lambda h, i: ~F.exists(F.slice("_named", i + 2, F.size("_named")), lambda later: later["key"] == h["key"]))
    rows = rows.withColumn("_headers", F.map_from_entries(F.coalesce(last, F.array().cast("array<struct<key:string,value:string>>"))))
    m = F.col("_r")
    columns = [
        m["id"].alias("id"), m["threadId"].alias("thread_id"), m["historyId"].alias("history_id"), F.coalesce(m["labelIds"], F.array().cast("array<string>")).alias("label_ids"),
        m["snippet"].alias("snippet"), m["sizeEstimate"].alias("size_estimate"), F.timestamp_millis(m["internalDate"].try_cast("bigint")).alias("internal_date"),
        *[F.col("_headers")[h].alias(c) for h, c in HEADERS.items()], F.col("_headers").alias("headers"),
    ]
    if body_chars is not None:
        columns.append(F.left(_body_text(raw), F.lit(body_chars)).alias("body_text"))
    return rows.select(*columns)


def mail_labels(df: DataFrame, raw: str = "raw") -> DataFrame:
    r = F.from_json(F.col(raw), ", ".join(f"{k} {v}" for k, v in _LABEL.items()))
    return df.select(*[r[k].alias(_snake(k)) for k in _LABEL])


def _bare(value: Column, kind: T.DataType, name: str) -> Column:
    """``value`` without fields called ``name``, at every level."""
    if isinstance(kind, T.StructType):
        fields = [_bare(value[f.name], f.dataType, name).alias(f.name) for f in kind if f.name != name]
        return F.when(value.isNotNull(), F.struct(*fields)) if fields else F.lit(None).cast("string")
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        return F.transform(value, lambda x: _bare(x, kind.elementType, name))
    return value


def sobjects(df: DataFrame, cursor: str | None = None, key: str = "Id", flag: str = "IsDeleted", envelope: str = "attributes", keep_flag: bool = True) -> DataFrame:
    """Records without their envelope; a deleted one keeps its key and cursor alone."""
    gone = F.coalesce(F.col(flag), F.lit(False)) if flag in df.columns else F.lit(False)
    fields = [f for f in df.schema if f.name not in (envelope, DELETED, None if keep_flag else flag)]
    columns = [_bare(F.col(f"`{f.name}`"), f.dataType, envelope) for f in fields]
    return df.select(*[(c if f.name in (key, cursor) else F.when(~gone, c)).alias(f.name) for f, c in zip(fields, columns, strict=True)], gone.alias(DELETED))


def chosen_fields(fields: Sequence[str], cursor: str | None = None, deletes: bool = True, key: str = "Id", flag: str = "IsDeleted") -> list[str]:
    """The key, the cursor and the deletion flag, then the configured fields; a name counts once, in any case."""
    wanted = [key, *([cursor] if cursor else []), *([flag] if deletes else []), *fields]
    return [name for i, name in enumerate(wanted) if name.lower() not in {w.lower() for w in wanted[:i]}]


def selected(df: DataFrame, fields: Sequence[str], where: str | None = None, cursor: str | None = None, last: object = None, deletes: bool = True, key: str = "Id", flag: str = "IsDeleted") -> DataFrame:
    """The chosen fields of the records that a configured condition lets through, from the last cursor on.

    The condition is one term, whatever operators it has: an ``or`` in it does not
    reach around the cursor.  Both go to the scan.  Without ``deletes`` deleted records stay out.
    """
    known = {c.lower(): c for c in df.columns}
    names = chosen_fields(fields, cursor, deletes, key, flag)
    if missing := [n for n in names if n.lower() not in known]:
        raise ValueError(f"no field {', '.join(map(repr, missing))}")
    rows = df if where is None else df.where(F.expr(f"({where})"))
    if cursor is not None and last is not None:
        rows = rows.where(F.col(f"`{known[cursor.lower()]}`") >= F.lit(last))
    if not deletes and flag.lower() in known:
        rows = rows.where(~F.coalesce(F.col(f"`{known[flag.lower()]}`"), F.lit(False)))
    return rows.select(*[F.col(f"`{known[n.lower()]}`") for n in names])


def page_records(df: DataFrame, selector: str, schema: str, raw: str = "raw") -> DataFrame:
    """The records of pages: the array, or the one object, that a dotted selector picks.  A page without it gives none."""
    picked = F.get_json_object(F.col(raw), "$." + selector if selector else "$")
    many = F.when(picked.startswith("["), picked).otherwise(F.concat(F.lit("["), picked, F.lit("]")))
    return df.select(F.explode(F.from_json(many, f"array<struct<{schema}>>")).alias("_r")).select("_r.*")
