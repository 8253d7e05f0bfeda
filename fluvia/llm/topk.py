"""Operator 12: exact top-k search by distributed selection on score histograms.

Components become floor(1024 * x); a score is the integer inner product.  Queries
are the rows whose vec_id is divisible by 100, candidates all rows but the query's
own.  Every pass scores all candidates: a task holds a chunk of them and streams the
queries block by block from the shared folder, so neither side is ever whole
anywhere, and no vectors are shuffled.  A pass counts scores in ``BINS`` equal bins of each
query's range; summed over all tasks, they name the bin that holds the query's kth
value, which is the next pass's range, until the bin is one value wide or few rows
lie at or above it.  (A chunk leaves out the bins below its own kth value, which can't
hold the kth of all.)  A last pass keeps scores at or above the bin's lower end; of
one chunk's ties the ``k`` smallest vec_ids are enough.  A window over what is left
ranks by score, then vec_id.

Vectors that are null or hold null or non-finite components take no part; vectors of
different lengths don't meet; empty vectors score 0 with each other.  Rows that repeat
a vec_id are candidates, and queries, of their own; a null vec_id is no query and comes last among
ties.  A score beyond 2^62 counts as 2^62.  An empty table gives no rows.  Other columns are left aside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

K, SCALE, EVERY = 10, 1024, 100
#: Bins of a pass; how many rows, as a multiple of k, may lie at or above a bin that is searched no further.
BINS, LOOSE = 256, 4
#: Candidates of a chunk, queries of a block and of a file.
CHUNK, BLOCK, FILE = 16_384, 128, 65_536
_MOST = 1 << 62


def _vectors(df: DataFrame, scale: int) -> DataFrame:
    """row, vec_id, dim, v (whole numbers as doubles, which is what floor gives), norm."""
    v = F.col("embedding").cast("array<double>")
    fine = F.col("embedding").isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # floor() of a double is a long, which would cut large values off.
    whole = F.transform(v, lambda x: x * scale - F.pmod(x * scale, F.lit(1.0)))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    rows = df.where(fine).select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
    return common.staged(rows.select("row", "vec_id", F.size("v").alias("dim"), "v", norm.alias("norm")), "integer-vectors")


def _flat(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of whole numbers: by doubles where these are exact, else by Python's integers."""
    if not q.shape[1]:
        return np.zeros((len(q), len(x)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2.0**53:
        return (q @ x.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    return np.clip(exact(q) @ exact(x).T, -_MOST, _MOST).astype(np.int64)


def _blocks(files: list[str]) -> Iterator[tuple[int, dict[str, np.ndarray], np.ndarray]]:
    """(dim, columns, vectors) of the queries, a block at a time."""
    for name in files:
        fs, at = common.file_system(name)
        with fs.open_input_file(at) as file:
            for batch in pq.ParquetFile(file).iter_batches(BLOCK):
                dims = batch.column("dim").to_numpy()
                for dim in np.unique(dims):
                    part = batch.filter(pa.array(dims == dim))
                    yield int(dim), {c: part.column(c).to_numpy() for c in ("row", "low", "width", "need")}, _flat(part.column("v"), int(dim))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, pa.Array, np.ndarray]]:
    """(dim, rows, vec_ids, vectors) of candidates, at most ``CHUNK`` at a time."""

    def out(held: list[pa.RecordBatch]):
        table = pa.Table.from_batches(held).combine_chunks()
        dims = table.column("dim").to_numpy()
        for dim in np.unique(dims):
            part = table.filter(pa.array(dims == dim)).combine_chunks()
            for a in range(0, part.num_rows, CHUNK):
                piece = part.slice(a, CHUNK).combine_chunks()
                yield int(dim), piece.column("row").to_numpy(), piece.column("vec_id"), _flat(piece.column("v").combine_chunks(), int(dim))

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= CHUNK:
            yield from out(held)
            held, n = [], 0
    if held:
        yield from out(held)


def _counted(files: list[str], bins: int):
    """Task: (query, bin, n) of the candidates' scores in each query's range."""
    schema = pa.schema([("query", pa.int64()), ("bin", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, rows, _, x in _chunks(batches):
            for of, columns, q in _blocks(files):
                if of != dim:
                    continue
                value = scores(q, x)
                low, width = columns["low"][:, None], columns["width"][:, None]
                inside = (value >= low) & ((value - low) // width < bins) & (columns["row"][:, None] != rows)
                # What lies below a chunk's own kth value in the range is below that of all.
                ranked = np.where(inside, value, np.iinfo(np.int64).min)
                most = min(int(columns["need"].max()), len(x))
                inside &= value >= np.partition(ranked, len(x) - most, axis=1)[:, len(x) - most, None]
                who, which = np.nonzero(inside)
                key, n = np.unique(who * bins + (value[who, which] - low[who, 0]) // width[who, 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(columns["row"][key // bins]), pa.array((key % bins).astype(np.int32)), pa.array(n.astype(np.int64))], schema=schema)

    return run


def _gathered(files: list[str], k: int):
    """Task: (query, vec_id, score) of what can be among a query's k best."""
    schema = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, rows, ids, x in _chunks(batches):
            order = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
            for of, columns, q in _blocks(files):
                if of != dim:
                    continue
                value = scores(q, x)
                who, which = np.nonzero((value >= columns["low"][:, None]) & (columns["row"][:, None] != rows))
                best = np.lexsort((order[which], -value[who, which], who))
                who, which = who[best], which[best]
                place = np.arange(len(who)) - np.searchsorted(who, who)
                who, which = who[place < k], which[place < k]
                yield pa.RecordBatch.from_arrays([pa.array(columns["row"][who]), ids.take(pa.array(which)).combine_chunks(), pa.array(value[who, which])], schema=schema)

    return run


def _written(queries: DataFrame, n: int) -> list[str]:
    """The files of the queries in the shared folder; each pass reads them block by block."""
    return common.staged(queries.repartition(1 + n // FILE), "queries").inputFiles() if n else []


def nearest(df: DataFrame, k: int = K, asked: Column | None = None, scale: int = SCALE, bins: int = BINS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of each query among the rows of ``df`` (vec_id, embedding)."""
    vectors = _vectors(df, scale)
    asked = F.col("vec_id") % EVERY == 0 if asked is None else asked
    reach = vectors.groupBy("dim").agg(F.max("norm").alias("reach"))
    # No score is larger than the product of the norms.
    bound = F.least(F.ceil(F.least(F.col("norm") * F.col("reach"), F.lit(float(_MOST // 4))) * 1.000001) + 1, F.lit(_MOST // 2))
    queries = vectors.where(asked).join(reach, "dim").select("row", F.col("vec_id").alias("query_id"), "dim", "v", (-bound).alias("low"), F.ceil((2.0 * bound + 1) / bins).cast("long").alias("width"), F.lit(k).cast("long").alias("need"), F.lit(True).alias("open"))
    queries = common.staged(queries, "queries")
    everyone = vectors.select("row", "vec_id", "dim", "v")
    while n := queries.where("open").count():
        counts = everyone.mapInArrow(_counted(_written(queries.where("open"), n), bins), "query long, bin int, n long").groupBy("query", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query").orderBy(F.col("bin").desc())
        # At most one row for each bin of a query.
        above = counts.withColumn("upto", F.sum("n").over(down)).withColumn("over", F.col("upto") - F.col("n"))
        found = queries.where("open").select(F.col("row").alias("query"), "need").join(above, "query").where("upto >= need").groupBy("query").agg(F.max_by(F.struct("bin", "upto", "over"), "bin").alias("kth"))
        state = queries.join(found.withColumnRenamed("query", "row"), "row", "left")
        # Fewer than k in all: every score counts, and the range stays as it is.
        low = F.when(F.col("kth").isNotNull(), F.col("low") + F.col("kth.bin") * F.col("width")).otherwise(F.col("low"))
        again = F.col("open") & F.col("kth").isNotNull() & (F.col("width") > 1) & (F.col("kth.upto") - F.col("need") + k > LOOSE * k)
        narrow = F.ceil(F.col("width") / bins).cast("long")
        state = state.select("row", "query_id", "dim", "v", low.alias("low"), F.when(again, narrow).otherwise(F.col("width")).alias("width"), F.when(again, F.col("need") - F.col("kth.over")).otherwise(F.col("need")).alias("need"), again.alias("open"))
        queries = common.staged(state, "queries")
    files = _written(queries, queries.count())
    hits = everyone.mapInArrow(_gathered(files, k), "query long, vec_id long, score long")
    place = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    best = hits.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    named = queries.select(F.col("row").alias("query"), "query_id")
    return best.join(named, "query").select("query_id", "rank", "vec_id", "score")


SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND q.row <> c.row AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {K}
"""
