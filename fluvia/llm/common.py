"""Helpers shared by the training-data operators.

Intermediate tables that are read more than once are written as Parquet under
the folder named in ``spark.checkpoint.dir``; they survive lost executors and
cut the lineage.  Where that is unset, a folder of our own is used in local mode,
and anything else is refused.  ``clear_scratch`` deletes what this application wrote
once its results are written.
"""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch that goes to a Python worker.
BATCH_ROWS, BATCH_BYTES = 256, 8 << 20
#: Rows that a Parquet reader decodes at once where they hold whole texts.
READ_ROWS = 512


@functools.cache
def _own_root() -> str:
    return "file://" + tempfile.mkdtemp(prefix="fluvia-")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share.  One of our own will do only where all run in one process."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _own_root()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    root = shared_root(spark).rstrip("/")
    if "://" not in root and not root.startswith("file:"):
        root = "file://" + root
    return f"{root}/fluvia-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; results that are not written yet can't be read afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch(spark, "x").rpartition("/")[0])
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound what one Arrow batch of whole texts holds."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def small_reads(spark: SparkSession) -> None:
    """Bound what a Parquet reader decodes at once: whole texts by the thousand (Spark's 4,096) take tens of MB a task, grown by doubling."""
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS)


def quoted(name: str) -> str:
    """A column's name as ``F.col`` takes it, dots and dashes included."""
    return "`" + name.replace("`", "``") + "`"


def row_of(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that columns made on the way clash with none; ``row.*`` gives them back."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns])


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, with as many underscores in front as it takes for ``df`` not to have them."""
    known, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in known:
            name = "_" + name
        out.append(name)
    return out


def text_of(name: str = "text") -> Column:
    """A null text is an empty one."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def record_batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``size`` rows from an iterator of tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, type=field.type) for column, field in zip(zip(*rows), schema, strict=True)],
        schema=schema,
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """What opens ``uri`` inside a task, and the path there."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)
