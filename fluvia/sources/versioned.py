"""Keyed tables in a folder that loads are merged into: buckets, versions, and a ledger in the same commit.

``root/log`` has one file for each version: the schema, the files of each bucket, and
the load that made it.  ``root/data`` has what loads wrote.  A row lies in the bucket
of its key's hash, so a merge reads and rewrites only the buckets that its rows fall
into.  A commit creates the next version's file, which fails where another writer
was faster; then only those buckets are rewritten that the other one touched, and
the next number is tried.  A load that is in the log is not landed again, so a run
repeated after a crash changes nothing.  Readers see one whole version.

The shared store must refuse a rename onto a file that is there (HDFS does; for
the local file system writers of one process take turns).
"""

from __future__ import annotations

import contextlib
import datetime as dt
import functools
import json
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import land

BUCKET, BUCKETS = "_bucket", 64

_ENTRY = "load_id string, run_id string, rows bigint, tombstones bigint, high string, taken array<string>, counts map<string, bigint>, warnings array<struct<reason: string, n: bigint, rows: array<string>>>, committed_at timestamp"
_GONE = "_gone"
_COMMIT = threading.Lock()

#: Row ids are noise to faster codecs, which leave them as long as they are.
_CODEC = "zstd"
#: Bytes of files that a task of a compaction takes.
_TASK_BYTES = 32 << 20
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Taken(RuntimeError):
    """Loads that a commit would take are in an earlier one."""


@dataclass(frozen=True)
class Version:
    number: int
    key: tuple[str, ...]
    buckets: int
    schema: T.StructType | None = None
    #: Folders of each bucket, below the root.
    files: Mapping[int, tuple[str, ...]] = field(default_factory=dict)
    load: Mapping[str, object] = field(default_factory=dict)


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time) of what lies in a folder."""
    where, fs = _path(spark, path)
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(where)] if fs.exists(where) else []


def _log_name(number: int) -> str:
    return f"{number:020d}.json"


def _read(spark: SparkSession, root: str, number: int) -> Version:
    where, fs = _path(spark, f"{root}/log/{_log_name(number)}")
    stream = fs.open(where)
    try:
        raw = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    schema = T.StructType.fromJson(raw["schema"]) if raw["schema"] else None
    return Version(number, tuple(raw["key"]), raw["buckets"], schema, {int(b): tuple(f) for b, f in raw["files"].items()}, raw.get("load") or {})


def _committed(spark: SparkSession, root: str, version: Version) -> bool:
    """Whether ``version`` became the one of its number."""
    jvm = spark.sparkContext._jvm
    schema = version.schema.jsonValue() if version.schema else None
    text = json.dumps({"key": version.key, "buckets": version.buckets, "schema": schema, "files": {str(b): f for b, f in version.files.items()}, "load": version.load or None}, default=str)
    temp, fs = _path(spark, f"{root}/log/.{uuid.uuid4().hex}")
    final, _ = _path(spark, f"{root}/log/{_log_name(version.number)}")
    out = fs.create(temp, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri() if final.isAbsolute() and final.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    with _COMMIT:
        if fs.exists(final):
            fs.delete(temp, False)
            return False
        context.rename(fs.makeQualified(temp), fs.makeQualified(final), options)
    return True


def create(spark: SparkSession, root: str, key: Sequence[str], buckets: int = BUCKETS) -> Version:
    """An empty table; ``buckets`` for good: so many that one's rows are some hundred MB at the size that the table will have."""
    if not key:
        raise ValueError("a keyed table needs a key")
    first = Version(0, tuple(key), buckets)
    if not _committed(spark, root, first):
        raise ValueError(f"there is a table at {root}")
    return first


def exists(spark: SparkSession, root: str) -> bool:
    return bool(_numbers(spark, root))


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(name[:-5]) for name, _ in _names(spark, f"{root}/log") if name.endswith(".json") and name[0] != "."]


def current(spark: SparkSession, root: str) -> Version:
    numbers = _numbers(spark, root)
    if not numbers:
        raise ValueError(f"no table at {root}")
    return _read(spark, root, max(numbers))


def _of(spark: SparkSession, root: str, version: Version, buckets: Sequence[int] | None = None) -> DataFrame:
    if version.schema is None:
        raise ValueError("the table has no columns yet")
    chosen = version.files if buckets is None else {b: version.files.get(b, ()) for b in buckets}
    paths = [f"{root}/{f}" for files in chosen.values() for f in files]
    return spark.read.schema(version.schema).parquet(*paths) if paths else spark.createDataFrame([], version.schema)


def table(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The rows of a version, of the newest one by default."""
    return _of(spark, root, current(spark, root) if number is None else _read(spark, root, number))


def by_buckets(spark: SparkSession, root: str, size: int = 256 << 20) -> list[DataFrame]:
    """The rows of the newest version, some buckets at a time (``size`` bytes of files, or one bucket): those of one key are in one of the frames."""
    version = current(spark, root)
    groups: list[list[int]] = []
    room = 0
    for b in sorted(version.files):
        room -= (own := _bytes(spark, root, version.files[b]))
        if not groups or room < 0:
            groups.append([])
            room = size - own
        groups[-1].append(b)
    return [_of(spark, root, version, g) for g in groups] or [_of(spark, root, version)]


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """(version, load_id, run_id, rows, tombstones, high, taken, counts, warnings, committed_at) of every commit that landed a load, from the log alone."""
    logged = spark.read.schema(f"load struct<{_ENTRY}>").option("pathGlobFilter", "[0-9]*.json").json(f"{root}/log")
    number = F.substring_index(F.element_at(F.split("_metadata.file_path", "/"), -1), ".", 1).cast("long")
    return logged.where("load is not null").select(number.alias("version"), "load.*")


def observed(shown: Observation) -> dict:
    """The values of an observation after its query has run; none where Spark saw that there are no rows and ran nothing."""
    try:
        return shown.get
    except Py4JJavaError:
        return {}


def _bucket(key: Sequence[str], buckets: int) -> Column:
    """By the key's texts, so that a wider type doesn't move a row."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in key]), F.lit(buckets)).cast("int").alias(BUCKET)


@contextlib.contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """What jobs inside deal out leaves the executors' disks when each has ended, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before) if before else spark.conf.unset(_CLEANUP)


def _written(df: DataFrame, key: Sequence[str], buckets: int, root: str, counted: Callable[[DataFrame], DataFrame] = lambda d: d) -> dict[int, tuple[str, ...]]:
    """The folders of each bucket that ``df`` has rows of.  Small buckets share a task, a large one has several.

    ``counted`` observes the rows in the stage that writes them: Spark counts a writing task once, however often what comes before is run again.
    """
    name = f"data/{uuid.uuid4().hex}"
    dealt = df.withColumn(BUCKET, _bucket(key, buckets)).hint("rebalance", BUCKET)
    with swept(df.sparkSession):
        counted(dealt).write.partitionBy(BUCKET).option("compression", _CODEC).parquet(f"{root}/{name}")
    return _folders(df.sparkSession, root, name)


def _folders(spark: SparkSession, root: str, name: str) -> dict[int, tuple[str, ...]]:
    return {int(n.split("=")[1]): (f"{name}/{n}",) for n, _ in _names(spark, f"{root}/{name}") if n.startswith(BUCKET)}


def _bytes(spark: SparkSession, root: str, folders: Sequence[str]) -> int:
    return sum(fs.getContentSummary(where).getLength() for where, fs in (_path(spark, f"{root}/{f}") for f in folders))


def _together(spark: SparkSession, root: str, version: Version, buckets: Sequence[int]) -> dict[int, tuple[str, ...]]:
    """The rows of these buckets as one folder each.  They lie in their bucket already: tasks read files and write them, nothing is dealt out."""
    name = f"data/{uuid.uuid4().hex}"
    # Two tasks a bucket at least: Spark makes one of all, where each has one.
    parts = [_of(spark, root, version, [b]).coalesce(2 + _bytes(spark, root, version.files[b]) // _TASK_BYTES).withColumn(BUCKET, F.lit(b)) for b in buckets]
    functools.reduce(DataFrame.unionAll, parts).write.partitionBy(BUCKET).option("compression", _CODEC).parquet(f"{root}/{name}")
    return _folders(spark, root, name)


def landed(spark: SparkSession, root: str, load: str) -> bool:
    return not ledger(spark, root).where(F.col("load_id") == load).isEmpty()


def _as_it_is(schema: T.StructType, new: T.StructType) -> bool:
    """Whether files with the columns ``new`` can be read under ``schema``: what both have is of one type."""
    types = {f.name: f.dataType for f in schema}
    return all(types.get(f.name, f.dataType) == f.dataType for f in new)


def merge(
    df: DataFrame, root: str, load: str, run: str | None = None, cursor: str | None = None, gone: str | None = None, whole: bool = False, entry: Mapping[str, object] | None = None, append: bool = False
) -> Version:
    """Rows with the keys of ``df`` go, ``df`` is added; one commit, with the load's entry in the ledger.

    ``cursor``: a column whose highest value is noted, as a text.  ``gone``: a boolean column; rows that
    have it remove their key and are not added.  ``whole``: the table becomes ``df``.  ``append``: nothing goes.
    ``entry``: what else is noted; loads that it has ``taken`` and that another commit took before are an error.  A stamp
    that a row lacks is an error before anything is committed.  Rows, deletions
    and the cursor are observed as the load is written, not counted again.  Where nothing is to be taken out (an empty
    bucket, a whole table, an append) and no column changed its type, what the load wrote is the table's file as it is.
    """
    spark = df.sparkSession
    if append and (whole or gone):
        raise ValueError("an append takes nothing out")
    base = current(spark, root)
    if landed(spark, root, load):
        return base
    if taken := list((entry or {}).get("taken") or ()):
        before = ledger(spark, root).where(F.arrays_overlap("taken", F.array(*map(F.lit, taken))))
        if not before.isEmpty():
            raise Taken(f"loads of {load!r} were taken by another run")
    keyed = land.merge_key(base.key, df)
    removed = F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)
    flag = F.coalesce(F.col(land.DELETED), F.lit(False)) if land.DELETED in df.columns and not gone else F.col(_GONE)
    high = F.max(F.col(cursor) if cursor else F.lit(None)).cast("string")
    shown = Observation()
    arriving = land.enforced(df).withColumn(_GONE, removed).select(*[c for c in df.columns if c != gone], _GONE)
    incoming = _written(arriving, keyed, base.buckets, root, lambda d: d.observe(shown, F.count(F.lit(1)).alias("rows"), F.count_if(flag).alias("tombstones"), high.alias("high")))
    seen = observed(shown)
    columns = T.StructType([f for f in df.schema if f.name != gone])
    done: dict[int, tuple[str, ...]] = {}
    work = set(incoming)
    while True:
        fits = gone is None and (whole or base.schema is None or _as_it_is(base.schema, columns))
        ready = {b for b in work if fits and (whole or append or not base.files.get(b))}
        rest = work - ready
        paths = [f"{root}/{f}" for b in sorted(rest) for f in incoming[b]]
        arrived = T.StructType([*columns, T.StructField(_GONE, T.BooleanType())])
        new = spark.read.schema(arrived).parquet(*paths) if paths else spark.createDataFrame([], arrived)
        rows = new.where(f"not {_GONE}").drop(_GONE)
        if base.schema is not None and not whole:
            old, rows = land.evolved(_of(spark, root, base, () if append else sorted(rest)), rows)
            if not append:
                # The join puts its keys first: the columns keep their order.
                rows = old.join(new.select(*keyed).distinct(), keyed, "left_anti").select(*[F.col(f"`{c}`") for c in old.columns]).unionByName(rows)
        # Files are read with nulls allowed, whatever the load's own frame said.
        schema = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in rows.schema])
        done |= {b: incoming[b] for b in ready}
        if rest:
            made = _written(rows, keyed, base.buckets, root)
            done |= {b: made.get(b, ()) for b in rest}
        kept = {} if whole else {b: f for b, f in base.files.items() if append or b not in done}
        files = {b: f for b in sorted(kept.keys() | done.keys()) if (f := (*kept.get(b, ()), *done.get(b, ())))}
        note = {"load_id": load, "run_id": run, "rows": seen.get("rows") or 0, "tombstones": seen.get("tombstones") or 0, "high": seen.get("high"), "committed_at": dt.datetime.now(dt.timezone.utc).isoformat(), **(entry or {})}
        version = Version(base.number + 1, base.key, base.buckets, schema, files, note)
        if _committed(spark, root, version):
            return version
        latest = current(spark, root)
        between = [_read(spark, root, n).load for n in range(base.number + 1, latest.number + 1)]
        if any(b.get("load_id") == load for b in between):
            return latest
        if set(taken) & {t for b in between for t in b.get("taken") or ()}:
            raise Taken(f"loads of {load!r} were taken by another run")
        # What the other writer left as it was stays as it is written; other columns make all of it anew.
        work = set(incoming) if latest.schema != base.schema else set() if append else {b for b in incoming if latest.files.get(b) != base.files.get(b)}
        base = latest


def append(df: DataFrame, root: str, load: str, run: str | None = None, cursor: str | None = None) -> Version:
    """Add ``df`` and read nothing of what is there; the table's key must be the stamped row id.

    Equal rows all stay: each row's id is made anew of the row, the load and its place among those written (128 bits of their hash).
    A load that is landed already adds nothing.
    """
    base = current(df.sparkSession, root)
    if base.key != (land.ROW,):
        raise ValueError("an append goes to a table whose key is the row id")
    if land.ROW not in df.columns:
        raise ValueError("rows that are appended have their stamps")
    told = F.sha2(F.concat_ws(":", F.col(land.ROW), F.lit(load), F.monotonically_increasing_id().cast("string")), 256)
    own = F.rtrim(F.base64(F.unhex(F.left(told, F.lit(32)))), F.lit("="))
    return merge(df.withColumn(land.ROW, F.when(F.col(land.ROW).isNotNull(), own)), root, load, run, cursor=cursor, append=True)


def compact(spark: SparkSession, root: str, most: int = 8) -> Version:
    """Buckets of more than ``most`` folders as one folder each, in a commit that lands nothing.

    What others append meanwhile stays behind what was compacted; a bucket that they rewrote is left to them.
    """
    base = current(spark, root)
    many = {b: f for b, f in base.files.items() if len(f) > most}
    if not many:
        return base
    made = _together(spark, root, base, sorted(many))
    while True:
        done = {b: (*made.get(b, ()), *base.files[b][len(f):]) for b, f in many.items() if base.files.get(b, ())[: len(f)] == f}
        version = Version(base.number + 1, base.key, base.buckets, base.schema, dict(base.files) | done)
        if not done or _committed(spark, root, version):
            return version if done else base
        base = current(spark, root)


def history(spark: SparkSession, root: str) -> list[tuple[int, str | None, T.StructType]]:
    """(version, load, schema) of every version that changed the columns, from the log alone."""
    out: list[tuple[int, str | None, T.StructType]] = []
    for number in sorted(_numbers(spark, root)):
        version = _read(spark, root, number)
        if version.schema is not None and (not out or [(f.name, f.dataType) for f in out[-1][2]] != [(f.name, f.dataType) for f in version.schema]):
            out.append((number, version.load.get("load_id"), version.schema))
    return out


def folders(spark: SparkSession, base: str) -> list[str]:
    """What lies right below ``base``."""
    return sorted(n for n, _ in _names(spark, base))


def purge(spark: SparkSession, roots: Sequence[str]) -> list[str]:
    """Delete these tables with their logs, cursors and schemas, and tell which were there; one that is still there is an error."""
    there = [r for r in roots if exists(spark, r)]
    for root in there:
        where, fs = _path(spark, root)
        fs.delete(where, True)
    if left := [r for r in there if exists(spark, r)]:
        raise RuntimeError(f"not deleted: {', '.join(left)}")
    return there


def replace(df: DataFrame, root: str, load: str, run: str | None = None) -> Version:
    """The whole table anew, with whatever columns, in one commit; an empty frame empties it."""
    return merge(df, root, load, run, whole=True)


def vacuum(spark: SparkSession, root: str, keep: int = 2, hours: float = 24) -> int:
    """Delete what none of the ``keep`` newest versions reads and no writer of the last ``hours`` has written; the log stays."""
    last = current(spark, root).number
    used = {f.split("/")[1] for n in range(max(0, last - keep + 1), last + 1) for files in _read(spark, root, n).files.values() for f in files}
    limit = dt.datetime.now(dt.timezone.utc).timestamp() * 1000 - hours * 3_600_000
    n = 0
    for name, at in _names(spark, f"{root}/data"):
        if name not in used and at <= limit:
            where, fs = _path(spark, f"{root}/data/{name}")
            fs.delete(where, True)
            n += 1
    return n
