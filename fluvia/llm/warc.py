"""Operator 3: WARC archives, written with revisit records and read in splits.

``write_warc`` leaves one archive of gzip members for each task.  Of pages with
equal payloads of at least ``REVISIT_BYTES`` the one with the smallest page_id is
a response, the others are revisit records without a payload.  ``read_warc``
cuts archives into byte ranges; a task looks for the gzip magic in its range,
accepts a candidate once what it holds up to the first blank line is a WARC header,
and owns the records that start inside, reading past the end of the range to finish
the last.  ``archived`` compares the records read with those written and fails if
they differ.

A null payload is an empty one.  Rows that repeat a page_id and payload are the
same page and share its record type.  A null page_id is written as such and read
back as null.  Payloads and urls of any length are written and read whole.  An empty
table gives no rows; further columns are ignored.  Payloads are UTF-8 text, which can't hold the gzip magic, so a
stored block can't pose as a member.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

REVISIT_BYTES, RANGE_BYTES, LEVEL, HOT = 100, 8 << 20, 6, 1000

# Fixed values of the WARC 1.1 and gzip formats.
MAGIC, HEAD = b"\x1f\x8b\x08", b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
NAME = "urn:x-page:"


def with_roles(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest and, for a revisit, the page that it refers to."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), common.text_of("html").alias("payload")).withColumn("digest", F.sha2("payload", 256))
    first = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = common.staged(first, "repeated-payloads")
    # Payloads on more than a thousandth of the rows, fewer than a thousand of them, are looked up in a broadcast table, the others by a join; no digest is dealt to one task whole.
    most = -(-pages.count() // HOT)
    often = F.broadcast(first.where(F.col("n") > most).select("digest", F.col("first").alias("often")))
    rows = rows.join(often, "digest", "left").withColumn("key", F.when(F.col("often").isNull(), F.col("digest")).otherwise(F.concat_ws(":", "digest", F.xxhash64("page_id", "url").cast("string"))))
    rows = rows.join(first.where(F.col("n") <= most).select(F.col("digest").alias("key"), "first"), "key", "left").withColumn("first", F.coalesce("often", "first"))
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.withColumn("refers_to", refers).select("page_id", "url", "payload", "digest", "refers_to")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{NAME}{page_id}>", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{NAME}{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return zlib.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", LEVEL, 31)


def write_warc(pages: DataFrame, path: str, least: int = REVISIT_BYTES) -> DataFrame:
    """Archives in ``path``; returns (file, records)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        fs, root = common.file_system(path)
        fs.create_dir(root, recursive=True)
        name = f"part-{task.partitionId():06d}.warc.gz"
        own, n = f"{root}/.{name}.{task.taskAttemptId()}", 0
        with fs.open_output_stream(own, buffer_size=1 << 20) as out:
            for batch in batches:
                for row in batch.to_pylist():
                    out.write(record(row["page_id"], row["url"], row["payload"].encode(), row["digest"], row["refers_to"]))
                    n += 1
        fs.move(own, f"{root}/{name}")
        yield pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([n], pa.int64())})

    common.small_batches(pages.sparkSession)
    rows = with_roles(pages, least)
    return common.staged(rows.mapInArrow(write, "file string, records long"), "warc-manifest")


class Archive:
    """A range of one archive."""

    def __init__(self, file, start: int, end: int) -> None:
        self.file, self.size, self.start, self.end = file, file.size(), start, end

    def member(self, at: int) -> tuple[bytes, int] | None:
        """The WARC record of the member at ``at`` and where it ends; None if none starts there."""
        decode, got, read, valid = zlib.decompressobj(31), bytearray(), at, False
        try:
            while not decode.eof:
                chunk = self.file.read_at(min(1 << 16, self.size - read), read) if read < self.size else b""
                if not chunk:
                    return None
                read += len(chunk)
                while chunk and not valid and not decode.eof:
                    seen = len(got)
                    got += decode.decompress(chunk, 1 << 14)
                    chunk = decode.unconsumed_tail
                    if not got.startswith(HEAD[: len(got)]):
                        return None
                    if (end := got.find(b"\r\n\r\n", max(0, seen - 3))) >= 0:
                        head = got[: end + 2]
                        if not (b"\r\nWARC-Type: " in head and b"\r\nContent-Length: " in head):
                            return None
                        valid = True
                if chunk and not decode.eof:
                    got += decode.decompress(chunk)
        except zlib.error:
            return None
        return (bytes(got), read - len(decode.unused_data)) if valid else None

    def records(self) -> Iterator[tuple[int, bytes]]:
        window = self.file.read_at(min(self.end + len(MAGIC) - 1, self.size) - self.start, self.start)
        at = self.start
        while at < self.end:
            k = window.find(MAGIC, at - self.start)
            if k < 0 or self.start + k >= self.end:
                return
            at = self.start + k
            if found := self.member(at):
                yield at, found[0]
                at = found[1]
            else:
                at += 1


def parsed(member: bytes) -> dict:
    """The fields of one record."""
    head, _, rest = member.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    declared = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    revisit = fields["WARC-Type"] == "revisit"
    length = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")) if revisit else len(payload)
    digest = declared if revisit else hashlib.sha256(payload).hexdigest()
    number = lambda x: int(x) if (x := x.strip("<>").removeprefix(NAME)) != "None" else None
    return {
        "page_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": length, "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": number(fields["WARC-Refers-To"]) if revisit else None,
        "intact": digest == declared, "payload": None if revisit else payload,
    }


def read_warc(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """A row for each record of the archives in ``path``; the payload of a revisit is null."""
    ranges = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path).select("path", "length").where("length > 0")
        .select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(length - 1) div {range_bytes}"))).alias("k"))
    )
    types = [("page_id", pa.int64(), "long"), ("url", pa.string(), "string"), ("payload_bytes", pa.int64(), "long"), ("payload_digest", pa.string(), "string"), ("record_type", pa.string(), "string"), ("refers_to", pa.int64(), "long"), ("intact", pa.bool_(), "boolean")]
    types += [("payload", pa.binary(), "binary")] * payloads + [("file", pa.string(), "string"), ("at", pa.int64(), "long")]
    schema = pa.schema([t[:2] for t in types])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for name, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    fs, where = common.file_system(name)
                    with fs.open_input_file(where) as file:
                        for at, member in Archive(file, k * range_bytes, min((k + 1) * range_bytes, file.size())).records():
                            got = parsed(member) | {"file": name.rpartition("/")[2], "at": at}
                            yield tuple(got[field.name] for field in schema)

        yield from common.record_batches(rows(), schema, 64 if payloads else 2048)

    tasks = spark.sparkContext.defaultParallelism * 4
    return ranges.select("path", "k").repartition(tasks, "path", "k").mapInArrow(read, ", ".join(f"{n} {t}" for n, _, t in types))


def archived(pages: DataFrame, path: str | None = None, least: int = REVISIT_BYTES, payloads: bool = True) -> DataFrame:
    """Write ``pages`` (page_id, url, html) and read the archives back; every record written must be read."""
    spark = pages.sparkSession
    path = path or common.scratch(spark, "warc")
    written = write_warc(pages, path, least).agg(F.sum("records")).first()[0]
    if not written:
        return spark.createDataFrame([], "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean" + ", payload binary" * payloads + ", file string, at long")
    read = common.staged(read_warc(spark, path, payloads=payloads), "warc-records")
    if (n := read.count()) != written:
        raise RuntimeError(f"{path}: {n} records read, {written} written")
    return read
