"""Landing and projection as streams of files.

Each micro-batch is written under its own number, so one that runs again after a
failure replaces what it wrote before.  ``drained`` reads what all batches wrote;
``landed`` merges them into a versioned table, ``appended`` adds them to one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.mapping import Cell
from ..operators import dispatch, land, project
from ..sources import versioned
from . import keyed

BATCH = keyed.BATCH


def drained(stream: DataFrame | keyed.Kept, path: str, step: Callable[[DataFrame], DataFrame] = lambda b: b, mode: str = "append") -> DataFrame:
    """Run ``step`` on each micro-batch until the source has no more, and read what they wrote (with ``_batch``).

    A stream under a rule of ``keyed`` is run as the rule has it.
    """
    if isinstance(stream, keyed.Kept):
        return stream.drained(path)

    def write(batch: DataFrame, number: int) -> None:
        out = step(batch)
        out.write.mode("overwrite").parquet(f"{path}/data/{BATCH}={number}")

    spark = stream.sparkSession
    stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    # Columns that only some batches have are null in the others.
    return spark.read.option("mergeSchema", "true").option("basePath", f"{path}/data").parquet(f"{path}/data")


def landed(stream: DataFrame, path: str, key: Sequence[str], order: Sequence[Column], binding: str, run: str, cursor: str | None = None, buckets: int = 16) -> DataFrame:
    """The current rows of a keyed stream, in a versioned table under ``path``: each micro-batch is merged under its own number.

    A batch that runs again after a failure is landed already, or wasn't at all; its cursor is
    noted in its own commit.  A reader opens one folder for each bucket, however many batches there were.
    """
    spark, root = stream.sparkSession, f"{path}/table"
    if not versioned.exists(spark, root):
        versioned.create(spark, root, key, buckets)

    def write(batch: DataFrame, number: int) -> None:
        versioned.merge(land.stamped(land.newest(batch, key, order), binding, run, run), root, f"batch {number}", run, cursor=cursor)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    rows = versioned.current(spark, root)
    if rows.schema is None:
        return land.stamped(spark.createDataFrame([], stream.schema), binding, run, run)
    return versioned.table(spark, root).select(*stream.columns, *land.STAMPS)


def appended(stream: DataFrame, path: str, binding: str, run: str, cursor: str | None = None, buckets: int = 16, most: int = 8) -> DataFrame:
    """All rows of a stream without a key, in a versioned table under ``path``: each micro-batch is appended under its own number, once.

    Where a bucket has come to more than ``most`` folders it is compacted, so that a reader opens at most
    ``most`` times ``buckets`` of them, however many batches there were.
    """
    spark, root = stream.sparkSession, f"{path}/table"
    if not versioned.exists(spark, root):
        versioned.create(spark, root, [land.ROW], buckets)

    def write(batch: DataFrame, number: int) -> None:
        load = f"batch {number}"
        versioned.append(land.stamped(batch, binding, run, load), root, load, run, cursor)
        versioned.compact(spark, root, most)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    if versioned.current(spark, root).schema is None:
        return land.stamped(spark.createDataFrame([], stream.schema), binding, run, run)
    return versioned.table(spark, root)


def projected(stream: DataFrame, path: str, cells: Callable[[DataFrame], Mapping[str, Cell]], identity: Sequence[str], required: Sequence[str] = (), filters: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """A landed stream's rows projected once each, collapsed over all batches."""

    def step(batch: DataFrame) -> DataFrame:
        return project.projected(batch, cells(batch), identity, required, filters(batch) if filters else None)

    return project.collapsed(drained(stream, path, step), identity)


def projected_once(
    stream: DataFrame, path: str, key: Sequence[str], order: Sequence[Column], binding: str, cells: Callable[[DataFrame], Mapping[str, Cell]], identity: Sequence[str],
    required: Sequence[str] = (), filters: Callable[[DataFrame], Column] | None = None, buckets: int = 16,
) -> DataFrame:
    """The target of a keyed stream: each micro-batch is a load, landed and then projected, either of them once.

    A batch that runs again after a failure finds its load in the landing table's log, and projects
    what the target's log does not have yet.
    """
    spark, landing, target = stream.sparkSession, f"{path}/table", f"{path}/target"
    for root, columns in ((landing, key), (target, identity)):
        if not versioned.exists(spark, root):
            versioned.create(spark, root, columns, buckets)

    def write(batch: DataFrame, number: int) -> None:
        load = f"batch {number}"
        versioned.merge(land.stamped(land.newest(batch, key, order), binding, load, load), landing, load)
        dispatch.dispatched(spark, landing, target, cells, identity, load, required, filters)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return versioned.table(spark, target)


def files(spark: SparkSession, path: str, schema, per_trigger: int = 100) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)
