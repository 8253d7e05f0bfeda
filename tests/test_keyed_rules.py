"""Rules over many deliveries: their time, what their state holds, and batches of Arrow's that end within a key."""

import datetime as dt
import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from fluvia.plans import registry, streams
from fluvia.streaming import deliveries, keyed, landing

SCHEMA = "subscription string, delivery_id string, body string, ts timestamp, id long"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


END = (None, "end", "", _at(10_000_000), -1)


@pytest.fixture
def small(spark):
    """Seven rows to a batch of Arrow's."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, "7")
    yield spark
    spark.conf.set(_BATCH, before)


def _come(spark, path, rule, *batches):
    rows = None
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/in")
        rows = landing.drained(rule(landing.files(spark, f"{path}/in", SCHEMA)), f"file://{path}/out")
    return rows


def _many(spark, path, rule, n=100_000):
    """What a rule gives of n deliveries, a hundred a subscription, in an hour; and its seconds."""
    k = F.col("id")
    ts = F.timestamp_micros(F.lit(1_700_000_000_000_000) + (k * 7919 % n) * F.lit(3_600_000_000 // n))
    rows = spark.range(n).select((k % (n // 100)).cast("string").alias("subscription"), F.lit("").alias("delivery_id"), (k % 3).cast("string").alias("body"), ts.alias("ts"), "id")
    rows.unionByName(spark.createDataFrame([END], SCHEMA)).repartition(4).write.parquet(f"{path}/in")
    began = time.time()
    got = landing.drained(rule(landing.files(spark, f"{path}/in", SCHEMA)), f"file://{path}/out").count()
    return got, time.time() - began


def test_many_deliveries_debounced(spark, tmp_path):
    """Keyed state of Spark's took over a minute for as many, a call for each delivery."""
    got, took = _many(spark, tmp_path, lambda s: keyed.debounced(s, "subscription", seconds=1))
    assert got == 100_000 and took < 60


def _opened(rows, within):
    """{(key, opened): dirty} by plain Python."""
    out, now = {}, {}
    for key, at in sorted((r[0], r[3]) for r in rows):
        if key in now and (at - now[key]).total_seconds() < within:
            out[key, now[key]] = True
        else:
            now[key] = at
            out[key, at] = False
    return out


def test_windows_over_batches_of_arrow_and_of_the_stream(small, tmp_path):
    rng = random.Random(11)
    rows = sorted([(rng.choice("aab"), "", "", _at(rng.randrange(4000) + rng.random()), k) for k in range(500)], key=lambda r: r[3])
    parts = [rows[:180], rows[180:181], rows[181:400], [*rows[400:], END]]
    got = _come(small, tmp_path, lambda s: keyed.debounced(s, "subscription", late="1 hour"), *parts).collect()
    assert {(r.key, r.opened): r.dirty for r in got} == _opened(rows, 30) and len(got) == len(_opened(rows, 30))
    assert all(r.runs_at - r.opened == dt.timedelta(seconds=30) for r in got)


def test_state_holds_what_is_open_and_waits(spark, tmp_path):
    """After a batch: the open windows and the deliveries that the watermark has not passed; the state before is gone."""
    rows = [("s", "", "", _at(t), t) for t in (0, 10, 590, 600, 605, 1195, 1200)]
    rule = lambda s: keyed.debounced(s, "subscription")
    for k, row in enumerate(rows):
        _come(spark, tmp_path, rule, [row])
    state = spark.read.parquet(f"file://{tmp_path}/out/data")
    kept = {(r._batch, r._part, r._at // 1_000_000 - 1_704_067_200) for r in state.where("_part in (1, 2)").collect()}
    # The watermark stands at 600: 600 is past, 605 on wait.
    assert {x[1:] for x in kept if x[0] == 6} == {(keyed.HOLDING, 590), (keyed.WAITING, 605), (keyed.WAITING, 1195), (keyed.WAITING, 1200)}
    assert {x[0] for x in kept} == {5, 6}
    got = _come(spark, tmp_path, rule, [END]).collect()
    assert {(r.opened, r.dirty) for r in got} == {(_at(0), True), (_at(590), True), (_at(1195), True)}


def test_a_batch_that_failed_runs_again(spark, tmp_path, monkeypatch):
    """The first run breaks behind what it wrote; late deliveries are left out, before as after."""
    rule = lambda s: keyed.debounced(s, "subscription")
    _come(spark, tmp_path, rule, [("s", "", "", _at(t), t) for t in (0, 5, 1000)])
    write = keyed.Kept._write
    with monkeypatch.context() as m:
        m.setattr(keyed.Kept, "_write", lambda *a: (write(*a), 1 / 0))
        with pytest.raises(Exception, match="division by zero"):
            _come(spark, tmp_path, rule, [("s", "", "", _at(t), t) for t in (100, 401, 2000)])
    got = _come(spark, tmp_path, rule, [END]).collect()
    assert {(r.opened, r.dirty) for r in got} == {(_at(0), True), (_at(401), False), (_at(1000), False), (_at(2000), False)}


def test_many_deliveries_of_bodies_once(spark, tmp_path):
    got, took = _many(spark, tmp_path, lambda s: keyed.once(deliveries.fingerprinted(s)))
    assert got == 100_000 and took < 60


def _once(rows, within):
    """{id: accepted} by plain Python, of deliveries that come in order."""
    last, out = {}, {}
    for subscription, delivery, body, at, k in sorted(rows, key=lambda r: (r[3], str(r[4]))):
        key = (subscription, delivery or body)
        out[k] = not key[1] or key not in last or (at - last[key]).total_seconds() >= within
        if out[k]:
            last[key] = at
    return out


def test_once_over_batches_of_arrow_and_of_the_stream(small, tmp_path):
    """Without a subscription, without a fingerprint, at one time: each in its place, whichever batch brings it."""
    rng = random.Random(13)
    rows = sorted([(rng.choice(["a", "b", None]), rng.choice(["", "d", "e"]), "", _at(rng.randrange(6000) / 2), k) for k in range(600)], key=lambda r: r[3])
    parts = [rows[:200], rows[200:201], rows[201:450], [*rows[450:], END]]
    got = _come(small, tmp_path, lambda s: keyed.once(deliveries.fingerprinted(s), seconds=60, late="1 hour"), *parts).where("id <> '-1'").collect()
    assert {int(r.id): r.accepted for r in got} == _once(rows, 60) and len(got) == 600


def test_what_has_no_fingerprint_is_accepted_however_late(spark, tmp_path):
    rule = lambda s: keyed.once(deliveries.fingerprinted(s))
    got = _come(spark, tmp_path, rule, [("s", "d", "", _at(0), 1), ("s", "", "", _at(5000), 2)], [("s", "", "", _at(1), 3), ("s", "d", "", _at(2), 4), ("s", "d", "", _at(5000), 5)], [END])
    assert {int(r.id): r.accepted for r in got.where("id <> '-1'").collect()} == {1: True, 2: True, 3: True, 5: True}


def test_events_whose_ids_are_not_their_own(spark, tmp_path):
    """Equal ids and none: every accepted body is given once."""
    rng = random.Random(17)
    rows = [(rng.choice([1, 2, 2, None]), _at(rng.randrange(2_000_000)), rng.choice([1, 2, None]), rng.choice(["error", "view", "click", "", None]), 1.0, "{}") for _ in range(200)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{tmp_path}/events.parquet/*.parquet')")
    want = con.execute(registry.SQL["stream_once"]).fetchall()
    got = streams.stream_once(spark, str(tmp_path)).collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)


def test_many_deliveries_by_minute(spark, tmp_path):
    got, took = _many(spark, tmp_path, lambda s: keyed.within_limit(s, most=2))
    assert got == 100_000 and took < 60


def test_a_minute_that_batches_share(spark, tmp_path):
    """The minute under way goes on with what it has accepted; one subscription is none."""
    rng = random.Random(19)
    rows = sorted([(rng.choice(["a", None]), "", "", _at(rng.randrange(900) + rng.random()), k) for k in range(400)], key=lambda r: r[3])
    parts = [rows[:150], rows[150:151], rows[151:300], [*rows[300:], END]]
    got = _come(spark, tmp_path, lambda s: keyed.within_limit(s, most=5, late="30 seconds"), *parts).where("id <> '-1'").collect()
    seen, want = {}, {}
    for key, _, _, at, k in rows:
        seen[key, at.replace(second=0, microsecond=0)] = n = seen.get((key, at.replace(second=0, microsecond=0)), 0) + 1
        want[k] = n <= 5
    assert {int(r.id): r.accepted for r in got} == want and len(got) == 400
    state = spark.read.parquet(f"file://{tmp_path}/out/data")
    assert state.where("_batch = 2 and _part = 2").count() <= 10
