"""Contents of files that are known to be landed, and the bookkeeping of files that changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of one content at most.
CEILING = 10 << 20


def fetched(contents: DataFrame, landed: DataFrame, references: DataFrame, key: Sequence[str], most_bytes: int | None = None) -> DataFrame:
    """key, length, content and state (ok, too_large) of the ``references`` (key) that are landed; others give no row.

    ``contents`` (key, length, content) is a scan such as Spark's binary files; a
    ceiling asked for counts up to the library's own.  What is too large isn't read.
    """
    most = CEILING if most_bytes is None else min(most_bytes, CEILING)
    known = references.select(*key).distinct().join(landed.select(*key), list(key), "left_semi")
    found = contents.join(known, list(key), "left_semi")
    fits = F.col("length") <= most
    return found.select(*key, "length", F.when(fits, F.col("content")).alias("content"), F.when(fits, "ok").otherwise("too_large").alias("state"))


def changed(listing: DataFrame, seen: DataFrame, key: Sequence[str], tag: str, keyed: bool = True) -> DataFrame:
    """The files of ``listing`` whose tag isn't the one last seen; a resource without a key is read whole, so nothing is skipped."""
    if not keyed:
        return listing
    was = seen.select(*key, F.col(tag).alias("_tag"))
    same = listing.join(was, list(key)).where(F.col(tag).isNotNull() & (F.col(tag) == F.col("_tag"))).select(*key)
    return listing.join(same, list(key), "left_anti")


def seen_after(seen: DataFrame, read: DataFrame, key: Sequence[str], tag: str) -> DataFrame:
    """The tags to keep once ``read`` is landed: those of its files, and of all others as before."""
    now = read.select(*key, tag)
    return seen.select(*key, tag).join(now.select(*key), list(key), "left_anti").unionByName(now)
