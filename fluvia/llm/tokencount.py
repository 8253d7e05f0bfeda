"""Operator 10: token counts by a separator scan over flat token files.

``write_flat`` leaves unindexed files of 16- or 32-bit ids in which an
end-of-document id follows each document.  ``scan_flat`` cuts the files into
byte ranges, finds the end ids of each block with one vectorised comparison,
and stitches documents that cross blocks by a prefix scan over the blocks of a
file (how many ends came before, and where the last one was).  The scan carries
three numbers a block; the ends themselves stay where they were found.  Counts and
the manifest (file, ordinal, doc_id) meet in a join that is dealt by file and ordinal.

An empty or null text has no tokens and one end id; a text of any length is one
document, in as many blocks as it takes.  Ids behind the last end of
a file are reported as a document with ``ended`` false.  Empty tables give no
files and no rows; repeated rows are counted each on its own; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, tokens

#: <|endoftext|> of the vocabulary; texts that spell it are ordinary text.
END, DTYPE, BLOCK_BYTES = 50_256, "<u2", 4 << 20


def write_flat(df: DataFrame, path: str, end: int = END, dtype: str = DTYPE, ranks: str | None = None) -> DataFrame:
    """One file for each task in ``path``; returns (file, ordinal, doc_id), written beside them."""
    ranks = ranks or tokens.default_ranks()
    schema = pa.schema([("file", pa.string()), ("ordinal", pa.int64()), ("doc_id", pa.int64())])
    stop, most = np.array([end], dtype).tobytes(), np.iinfo(np.dtype(dtype)).max

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, encode = TaskContext.get(), tokens.codec(ranks, specials=False).encode
        name = f"part-{task.partitionId():06d}.bin"
        fs, root = common.file_system(path)
        fs.create_dir(root, recursive=True)
        # An attempt writes under a name of its own and then takes the final one.
        own = f"{root}/.{name}.{task.taskAttemptId()}"

        def rows(out):
            ordinal = 0
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = np.frombuffer(encode(text.as_py()), "<u4")
                    if len(ids) and ids.max() > most:
                        raise ValueError(f"token id {ids.max()} doesn't go into {dtype}: write with a wider dtype")
                    out.write(ids.astype(dtype).tobytes() + stop)
                    yield name, ordinal, doc_id
                    ordinal += 1

        with fs.open_output_stream(own, buffer_size=1 << 20) as out:
            yield from common.record_batches(rows(out), schema)
        fs.move(own, f"{root}/{name}")

    common.small_batches(df.sparkSession)
    written = df.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("text")).mapInArrow(write, "file string, ordinal long, doc_id long")
    return common.staged(written, "flat-manifest")


def scan_flat(spark: SparkSession, path: str, end: int = END, dtype: str = DTYPE, block: int = BLOCK_BYTES) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended) of every document in the files of ``path``."""
    width = np.dtype(dtype).itemsize
    block -= block % width
    blocks = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(path)
        .select("path", "length").where("length > 0")
        .select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(length - 1) div {block}"))).alias("block"))
    )
    n_blocks = max(1, spark.sparkContext.defaultParallelism * 4)
    schema = pa.schema([("path", pa.string()), ("block", pa.int64()), ("first", pa.int64()), ("size", pa.int64()), ("ends", pa.list_(pa.int64()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for name, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    fs, at = common.file_system(name)
                    with fs.open_input_file(at) as file:
                        ids = np.frombuffer(file.read_at(min(block, file.size() - k * block), k * block), dtype)
                    first = k * block // width
                    yield name, k, first, len(ids), np.flatnonzero(ids == end) + first

        yield from common.record_batches(rows(), schema, 1)

    found = blocks.select("path", "block").repartition(n_blocks, "path", "block").mapInArrow(scan, "path string, block long, first long, size long, ends array<long>")
    found = common.staged(found.withColumns({"n_ends": F.size("ends").cast("long"), "last_end": F.expr("try_element_at(ends, -1)")}), "ends")
    # A few numbers for each block of a file.
    by_file = Window.partitionBy("path").orderBy("block")
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.select(
        "path", "block",
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.max("last_end").over(before), F.lit(-1)).alias("previous"),
        F.lead("block").over(by_file).isNull().alias("last"),
    )
    found = found.join(stitched, ["path", "block"])
    file = F.element_at(F.split("path", "/"), -1).alias("file")
    stop = F.col("first") + F.col("size")
    # The last block of a file may leave ids behind its last end.
    ends = F.when(F.col("last") & (F.coalesce("last_end", "previous") < stop - 1), F.concat("ends", F.array(stop))).otherwise(F.col("ends"))
    each = found.select(file, "base", "previous", stop.alias("stop"), ends.alias("ends")).select("*", F.posexplode("ends").alias("k", "at"))
    start = F.when(F.col("k") == 0, F.col("previous")).otherwise(F.get("ends", F.col("k") - 1)) + 1
    return each.select("file", (F.col("base") + F.col("k")).alias("ordinal"), start.alias("start"), (F.col("at") - start).alias("n_tokens"), (F.col("at") < F.col("stop")).alias("ended"))


def count_tokens(df: DataFrame, path: str | None = None, end: int = END, dtype: str = DTYPE, ranks: str | None = None, block: int = BLOCK_BYTES) -> DataFrame:
    """Write ``df`` flat, scan it and give each document its count."""
    spark = df.sparkSession
    path = path or common.scratch(spark, "flat")
    names = write_flat(df, path, end, dtype, ranks)
    if names.isEmpty():
        return spark.createDataFrame([], "doc_id long, file string, ordinal long, start long, n_tokens long")
    return scan_flat(spark, path, end, dtype, block).join(names.hint("shuffle_hash"), ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens")
