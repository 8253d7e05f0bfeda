"""What appended tables and their compaction take of the disk."""

import os
import time

from pyspark.sql import functions as F

from fluvia.operators import land
from fluvia.sources import versioned

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffled(spark):
    """Shuffle files that lie in the session's own folders."""
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def _gone(spark, before):
    end = time.time() + 20
    while _shuffled(spark) - before and time.time() < end:
        time.sleep(0.2)
    return not _shuffled(spark) - before


def _size(path):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_appends_take_little_of_the_disk(spark, tmp_path):
    """Ids are most of a narrow row; what a load deals out goes with the load, and a compaction deals out nothing."""
    root, before = f"file://{tmp_path}/t", spark.conf.get(_CLEANUP)
    versioned.create(spark, root, [land.ROW], 4)
    was = _shuffled(spark)
    for load in ("1", "2"):
        rows = spark.range(100_000).select((F.col("id") % 50).alias("v"))
        versioned.append(land.stamped(rows, "b", "r", load), root, load)
    assert _gone(spark, was) and spark.conf.get(_CLEANUP) == before
    assert _size(tmp_path) < 200_000 * 30
    files = versioned.current(spark, root).files
    assert all(len(f) == 2 for f in files.values())
    by_id = lambda: {b: {r[0] for r in df.select(land.ROW).collect()} for b, df in zip(sorted(files), versioned.by_buckets(spark, root, 1))}
    ids = by_id()
    assert len(versioned.by_buckets(spark, root)) == 1
    versioned.compact(spark, root, 1)
    assert all(len(f) == 1 for f in versioned.current(spark, root).files.values()) and by_id() == ids
    assert sum(map(len, ids.values())) == len(set().union(*ids.values())) == 200_000 and {len(i) for i in ids[0]} == {22}
    counts = versioned.table(spark, root).groupBy(land.LOAD, "v").count().collect()
    assert len(counts) == 100 and {r["count"] for r in counts} == {2000}
    # Readers of an id find it where a merge looks for it.
    gone = versioned.table(spark, root).where("v = 7").limit(3).withColumn("out", F.lit(True))
    versioned.merge(gone, root, "3", gone="out")
    assert versioned.table(spark, root).count() == 199_997
