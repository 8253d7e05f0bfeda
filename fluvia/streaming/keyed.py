"""Deliveries by keyed state: acceptance in the order of event time, whatever the micro-batches.

A rule's state are tables beside what it gives, written in the same job: deliveries
that the watermark has not passed, and for each key what still holds (the accepted
delivery, the open window).  A micro-batch takes the deliveries that the watermark has passed by now,
sorted by key and time in Spark, behind what holds for their key.  State holds ids
and times alone (no bodies), and goes when a rule's time is over.  What comes later
than the watermark allows is dropped, as Spark's own windows have it.
"""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# How long an accepted delivery is remembered, how long a window stays open, deliveries of a minute.
DEDUPE_S, WINDOW_S, PER_MINUTE = 600, 30, 120

#: What a batch writes, by folder: what the rule gives; deliveries before the watermark; what holds for the next batch; the watermark.
BATCH, PART, GIVEN, WAITING, HOLDING, MARK = "_batch", "_part", 0, 1, 2, 3
#: Of the rows of all of these: microseconds, the id as a text, and what the rule says of it.
_AT, _ID, _SAYS = "_at", "_id", "_says"
#: Whether a row is what holds for its key, not a delivery.
_HELD = "_held"

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextlib.contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep Spark's own state, where they have any, in RocksDB; the session is left as it was."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


@dataclass(frozen=True)
class Kept:
    """A stream under a rule; ``landing.drained`` runs it.

    ``judged``: rows of ``key``, time and id, those that hold among them, with what the rule says of each.  ``parts``: where
    such a row goes when the watermark (microseconds) stands there.  ``shown``: the columns that the rule gives.  ``always``: what is
    accepted whenever it comes.
    """

    stream: DataFrame
    ts: str
    late: str
    key: tuple[str, ...]
    judged: Callable[[DataFrame], DataFrame]
    parts: Callable[[int], Column]
    shown: Sequence[Column]
    always: str = "false"

    def drained(self, path: str) -> DataFrame:
        """Run the rule on each micro-batch until the source has no more, and read what all of them gave (with ``_batch``)."""
        run = self.stream.writeStream.foreachBatch(lambda batch, number: self._write(batch, number, f"{path}/data"))
        run.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        given = self._read(self.stream.sparkSession, f"{path}/data", f"{BATCH} int").where(F.col(PART) == GIVEN)
        return given.select(*self.shown, BATCH)

    def _read(self, spark: SparkSession, path: str, *more: str) -> DataFrame:
        keys = [f"`{k}` {self.stream.schema[k].dataType.simpleString()}" for k in self.key]
        return spark.read.schema(", ".join([*keys, f"{_ID} string, {_AT} long, {_SAYS} boolean, {PART} int", *more])).parquet(path)

    def _write(self, batch: DataFrame, number: int, data: str) -> None:
        """One job writes what the rule gives and the state behind it, so that a batch that runs again after a failure replaces both."""
        spark = batch.sparkSession
        timed = batch.where(F.col(self.ts).isNotNull())
        newest = timed.agg((F.unix_millis(F.max(self.ts) - F.expr(f"interval {self.late}")) * 1000).alias("at")).first().at
        every = timed.select(*self.key, _ID, F.unix_micros(self.ts).alias(_AT), F.lit(None).cast("boolean").alias(_SAYS), F.lit(False).alias(_HELD))
        rows, mark = every.where(f"not ({self.always})"), newest
        if number:
            before = self._read(spark, f"{data}/{BATCH}={number - 1}")
            last = before.where(F.col(PART) == MARK).first()[_AT]
            if last is not None:
                mark = last if newest is None else max(last, newest)
                rows = rows.where(F.col(_AT) > last)
            state = before.where(F.col(PART).isin(WAITING, HOLDING))
            rows = rows.unionByName(state.select(*self.key, _ID, _AT, _SAYS, (F.col(PART) == HOLDING).alias(_HELD)))
            # The batch before is done, so the state that it began with is not read again.
            _forget(spark, [f"{data}/{BATCH}={number - 2}/{PART}={part}" for part in (WAITING, HOLDING)])
        columns = [*self.key, _ID, _AT, _SAYS]
        passed = F.col(_HELD) | (F.col(_AT) <= F.lit(mark)) if mark is not None else F.lit(False)
        ready = self.judged(rows.where(passed)).select(*columns, F.explode(self.parts(mark or 0)).alias(PART))
        free = every.where(self.always).withColumn(_SAYS, F.lit(True)).select(*columns, F.lit(GIVEN).alias(PART))
        waiting = rows.where(~passed).select(*columns, F.lit(WAITING).alias(PART))
        noted = spark.range(1, numPartitions=1).select(*[F.lit(mark if c == _AT else None).cast(ready.schema[c].dataType).alias(c) for c in columns], F.lit(MARK).alias(PART))
        ready.unionByName(free).unionByName(waiting).unionByName(noted).write.mode("overwrite").partitionBy(PART).parquet(f"{data}/{BATCH}={number}")


def _forget(spark: SparkSession, paths: Sequence[str]) -> None:
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _fresh(rows: pa.RecordBatch, key: Sequence[str], within: int) -> np.ndarray:
    """The places of those that nothing holds for: a key's first, and then the first that is ``within`` or more behind the last of them."""
    begins = np.zeros(rows.num_rows, bool)
    begins[:1] = True
    for name in key:
        codes = rows.column(name).dictionary_encode("encode").indices.to_numpy()
        begins[1:] |= codes[1:] != codes[:-1]
    places, last = [], 0
    for k, (new, at) in enumerate(zip(begins.tolist(), rows.column(_AT).to_pylist())):
        if new or at - last >= within:
            places.append(k)
            last = at
    return np.array(places)


def _saying(rows: pa.RecordBatch, says: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(says) if f.name == _SAYS else rows.column(f.name) for f in rows.schema], schema=rows.schema)


def _accepted(batches: Iterator[pa.RecordBatch], key: Sequence[str], within: int) -> Iterator[pa.RecordBatch]:
    """Every row, with whether it is accepted.  The last one accepted goes ahead of the next batch."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if last is None else pa.concat_batches([last, batch])
        fresh = _fresh(rows, key, within)
        says = np.zeros(rows.num_rows, bool)
        says[fresh] = True
        yield _saying(rows, says).slice(rows.num_rows - batch.num_rows)
        last = rows.slice(fresh[-1], 1)


def _windows(batches: Iterator[pa.RecordBatch], key: Sequence[str], within: int) -> Iterator[pa.RecordBatch]:
    """A row for each window, that of its first delivery, with whether others came.  The last one, which may go on, goes ahead of the next batch."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if last is None else pa.concat_batches([last, batch])
        fresh = _fresh(rows, key, within)
        more = np.diff(np.append(fresh, rows.num_rows)) > 1
        was = rows.column(_SAYS).take(pa.array(fresh)).fill_null(False).to_numpy(zero_copy_only=False)
        opened = _saying(rows.take(pa.array(fresh)), more | was)
        yield opened.slice(0, len(fresh) - 1)
        last = opened.slice(len(fresh) - 1)
    if last is not None:
        yield last


def _in_order(rows: DataFrame, key: Sequence[str], fold: Callable[..., Iterator[pa.RecordBatch]], within: int) -> DataFrame:
    """``fold`` over the rows of each key in order of their time: what holds, then deliveries, those of one time by id.  A task holds a batch of Arrow's, not a key."""
    dealt = rows.repartition(*key).sortWithinPartitions(*key, _AT, F.desc(_HELD), F.asc_nulls_last(_ID))
    return dealt.mapInArrow(functools.partial(fold, key=list(key), within=within), rows.schema)


def _timed(df: DataFrame, tie: str) -> DataFrame:
    return df.withColumn(_ID, F.col(tie).cast("string"))


def _each(until: Column) -> Callable[[int], Column]:
    """Deliveries are given at once; those that were accepted hold ``until`` then."""
    given = F.when(~F.col(_HELD), F.lit(GIVEN))
    return lambda mark: F.array_compact(F.array(given, F.when(F.col(_SAYS) & (until > F.lit(mark)), F.lit(HOLDING))))


def _told(key: str) -> list[Column]:
    return [F.col(key), F.col(_ID).alias("id"), F.timestamp_micros(_AT).alias("at"), F.col(_SAYS).alias("accepted")]


def once(df: DataFrame, ts: str = "ts", tie: str = "id", seconds: int = DEDUPE_S, late: str = "10 minutes") -> Kept:
    """(subscription, fingerprint, id, at, accepted) of a stream: of equal deliveries of a subscription the first is accepted, and holds for ``seconds``.

    A delivery without a fingerprint is always accepted.  Of deliveries of one time the lowest id (``tie``, as a text) comes first.
    """
    key, within = ("subscription", "fingerprint"), seconds * 1_000_000
    subscription, *rest = _told("subscription")
    return Kept(
        _timed(df, tie), ts, late, key, lambda rows: _in_order(rows, key, _accepted, within), _each(F.col(_AT) + F.lit(within)),
        [subscription, F.col("fingerprint"), *rest], always="fingerprint is null",
    )


def within_limit(df: DataFrame, ts: str = "ts", tie: str = "id", most: int = PER_MINUTE, late: str = "10 minutes") -> Kept:
    """(subscription, id, at, accepted): the first ``most`` deliveries of a subscription in each minute of the clock are accepted.

    They are ranked by subscription and minute, so that a busy subscription is many groups; of the minute under way those that were accepted stay in the state.
    """
    minute = F.expr(f"{_AT} div 60000000")
    order = Window.partitionBy("subscription", minute).orderBy(_AT, F.desc(_HELD), F.asc_nulls_last(_ID))
    return Kept(
        _timed(df, tie), ts, late, ("subscription",), lambda rows: rows.withColumn(_SAYS, F.row_number().over(order) <= most), _each((minute + 1) * 60_000_000),
        _told("subscription"),
    )


def debounced(df: DataFrame, key: str = "key", ts: str = "ts", tie: str = "id", seconds: int = WINDOW_S, late: str = "10 minutes") -> Kept:
    """(key, opened, runs_at, dirty): the first delivery opens a window of ``seconds``, the others in it only mark it dirty.

    A window is given once the watermark has passed its end.
    """
    within = seconds * 1_000_000
    end = F.col(_AT) + F.lit(within)
    return Kept(
        _timed(df, tie), ts, late, (key,), lambda rows: _in_order(rows, [key], _windows, within), lambda mark: F.array(F.when(end > F.lit(mark), F.lit(HOLDING)).otherwise(F.lit(GIVEN))),
        [F.col(key).alias("key"), F.timestamp_micros(_AT).alias("opened"), F.timestamp_micros(end).alias("runs_at"), F.col(_SAYS).alias("dirty")],
    )
