"""Files: a path is a folder, a single file or a glob (``**`` spans folders)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.feeds import glob_pattern

# Formats and the readers and options that they go to.
FORMATS = {"jsonl": ("json", {}), "csv": ("csv", {"header": "true"}), "parquet": ("parquet", {})}

#: A file's name: an extension that is no number.
FILE = re.compile(r"^[^?#/]+\.(?![0-9]+$)[A-Za-z0-9]+$")


def located(path: str) -> tuple[str, str]:
    """The folder that a path starts from and the glob of the files below it."""
    if "://" not in path and not path.startswith("/"):
        raise ValueError(f"a path is absolute or has a scheme: {path!r}")
    parts = path.rstrip("/").split("/")
    wild = next((i for i, p in enumerate(parts) if any(c in p for c in "*?[")), None)
    if wild is not None:
        return "/".join(parts[:wild]) or "/", "/".join(parts[wild:])
    return ("/".join(parts[:-1]) or "/", parts[-1]) if FILE.match(parts[-1]) else ("/".join(parts) or "/", "*")


def _below(path: str, base: str) -> Column:
    """The part of a file's path after the folder."""
    folder = base.split("://")[-1].rstrip("/") + "/"
    return F.substring(path, F.locate(folder, F.col(path)) + len(folder), F.length(path))


def listing(spark: SparkSession, path: str, contains: str | None = None) -> DataFrame:
    """(path, name, size, modified_at) of the files at ``path``; contents are not read."""
    base, glob = located(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base).select("path", "length", "modificationTime")
    out = files.where(_below("path", base).rlike(glob_pattern(glob))).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified_at"))
    return out if contains is None else out.where(F.contains(F.lower("name"), F.lit(contains.lower())))


def records(spark: SparkSession, path: str, format: str, schema: str | None = None) -> DataFrame:  # noqa: A002
    """The records of the files at ``path``."""
    kind, options = FORMATS[format]
    base, glob = located(path)
    reader = spark.read.format(kind).options(**options)
    if schema:
        reader = reader.schema(schema)
    if "/" not in glob:
        return reader.option("pathGlobFilter", glob).load(base)
    rows = reader.option("recursiveFileLookup", "true").load(base)
    return rows.where(_below("_metadata.file_path", base).rlike(glob_pattern(glob)))
