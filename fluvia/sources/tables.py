"""Landing tables in the session's catalog: append, replace, merge, purge, and the folder that jobs share."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators import land


@functools.cache
def _own_root() -> str:
    return "file://" + tempfile.mkdtemp(prefix="fluvia-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``; a folder of our own only where that is unset and all runs in one process."""
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _own_root()
    root = root.rstrip("/")
    return f"{root if ':' in root else 'file://' + root}/fluvia-{context.applicationId}/{name}-{uuid.uuid4().hex}"


def append(df: DataFrame, table: str, key: Sequence[str] = ()) -> None:
    if key:
        raise ValueError("an append takes no key")
    df.write.mode("append").saveAsTable(table)


def replace(df: DataFrame, table: str) -> None:
    """The whole table anew; an empty frame empties it.  With the same columns it changes at once, as by a merge."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.saveAsTable(table)
        return
    version = _version(spark, table)
    df.write.parquet(version)
    if [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in df.schema]:
        _point(spark, table, version)
        return
    # Columns can't be taken from a table: it is made again from what is written by then.
    purge(spark, [table])
    spark.read.schema(df.schema).parquet(version).write.saveAsTable(table)
    _delete(spark, version)


def merge(df: DataFrame, table: str, key: Sequence[str]) -> None:
    """Rows with the keys of ``df`` go, ``df`` is added.

    The next version is written beside the one that is read, and the table is pointed
    to it by one change of its location: at any time a reader finds one whole version.
    The version before stays for those that are reading it, and goes with the next merge.
    """
    if not key:
        raise ValueError("a merge needs a key")
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return replace(df, table)
    have = spark.table(table)
    old, new = land.evolved(have, df)
    version = _version(spark, table)
    land.merged(old, new, key).write.parquet(version)
    added = [f"`{f.name}` {f.dataType.simpleString()}" for f in old.schema if f.name not in have.columns]
    if added:
        spark.sql(f"alter table {table} add columns ({', '.join(added)})")
    _point(spark, table, version)


def _location(spark: SparkSession, table: str) -> str:
    return next(r.data_type for r in spark.sql(f"describe formatted {table}").collect() if r.col_name == "Location")


def _version(spark: SparkSession, table: str) -> str:
    """A path for the next version beside the first one."""
    return f"{_location(spark, table).partition('__version_')[0]}__version_{uuid.uuid4().hex[:12]}"


def _point(spark: SparkSession, table: str, version: str) -> None:
    """Readers find ``version`` from now on; the one before stays, the one before that goes."""
    at = _location(spark, table)
    spark.sql(f"alter table {table} set location '{version}'")
    spark.catalog.refreshTable(table)
    before = spark.sql(f"show tblproperties {table}").where("key = 'fluvia.before'").collect()
    if before:
        _delete(spark, before[0].value)
    spark.sql(f"alter table {table} set tblproperties ('fluvia.before' = '{at}')")


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def purge(spark: SparkSession, tables: Sequence[str]) -> None:
    """Drop these tables, their versions with them; those that are still there are an error."""
    for table in tables:
        if not spark.catalog.tableExists(table):
            continue
        before = spark.sql(f"show tblproperties {table}").where("key = 'fluvia.before'").collect()
        places = [_location(spark, table), *(r.value for r in before)]
        spark.sql(f"drop table if exists {table} purge")
        for place in places:
            _delete(spark, place)
    left = [t for t in tables if spark.catalog.tableExists(t)]
    if left:
        raise RuntimeError(f"not dropped: {', '.join(left)}")
