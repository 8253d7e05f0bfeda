"""Acceptance of deliveries by keyed state, held against plain Python."""

import datetime as dt
import random

import pytest

from fluvia.streaming import deliveries, keyed, landing

SCHEMA = "subscription string, delivery_id string, body string, ts timestamp, id long"


def _at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def _run(spark, path, rule, *batches):
    """The rows that a rule gives; each batch is a run of the stream, the last one ends with a delivery later than all."""
    rows = None
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/in")
        with keyed.keyed_state(spark):
            rows = landing.drained(rule(landing.files(spark, f"{path}/in", SCHEMA)), f"file://{path}/out")
    return rows.collect()


END = (None, "end", "", _at(10_000_000), -1)


def _once(rows, within=600):
    last, out = {}, {}
    for r in sorted((r for r in rows if r[0]), key=lambda r: (r[3], str(r[4]))):
        key = (r[0], r[1] or r[2])
        if not (r[1] or r[2]):
            out[r[4]] = True
            continue
        out[r[4]] = key not in last or (r[3] - last[key]).total_seconds() >= within
        if out[r[4]]:
            last[key] = r[3]
    return out


def test_an_accepted_delivery_holds_for_ten_minutes(spark, tmp_path):
    """At 10:00, 10:30 and 11:00 all three are accepted; five minutes apart one of two is, whichever batches bring them."""
    apart = [("s", "d1", "x", _at(1800 * k), k) for k in range(3)]
    near = [("s", "d2", "x", _at(300 * k), 10 + k) for k in range(3)] + [("s", "d2", "x", _at(599.999), 13), ("t", "d2", "x", _at(0), 14), ("s", None, "", _at(0), 15), ("s", "", None, _at(1), 16)]
    got = _run(spark, tmp_path / "one", lambda s: keyed.once(deliveries.fingerprinted(s)), [*apart, *near, END])
    want = {0: True, 1: True, 2: True, 10: True, 11: False, 12: True, 13: False, 14: True, 15: True, 16: True}
    assert {int(r.id): r.accepted for r in got if r.id != "-1"} == want == _once([*apart, *near])
    got = _run(spark, tmp_path / "three", lambda s: keyed.once(deliveries.fingerprinted(s)), [apart[0], *near[:2]], [apart[1]], [apart[2], END])
    assert {int(r.id): r.accepted for r in got if r.id != "-1"} == {0: True, 1: True, 2: True, 10: True, 11: False}


def test_once_equals_brute_force(spark, tmp_path):
    rng = random.Random(7)
    rows = [(rng.choice("st"), rng.choice(["", "a", "b"]), rng.choice(["", "x"]), _at(rng.randrange(20_000) + rng.random()), k) for k in range(400)]
    rows += [("s", "a", "", _at(5), 1000 + k) for k in range(5)]
    got = _run(spark, tmp_path, lambda s: keyed.once(deliveries.fingerprinted(s)), [*rows, END])
    want = _once([(s, d and "d" + d, b and "b" + b, t, k) for s, d, b, t, k in rows])
    assert {int(r.id): r.accepted for r in got if r.id != "-1"} == want


@pytest.mark.parametrize("batches", [1, 2])
def test_limit_counts_the_minutes_of_the_clock(spark, tmp_path, batches):
    rng = random.Random(batches)
    rows = sorted([("s" if k % 3 else "t", "", "", _at(rng.randrange(600)), k) for k in range(200)], key=lambda r: r[3])
    cut = len(rows) // 2 if batches == 2 else 0
    # The second run begins at a time that the first one did not reach.
    while cut and rows[cut][3] == rows[cut - 1][3]:
        cut += 1
    parts = [rows[:cut], [*rows[cut:], END]] if cut else [[*rows, END]]
    got = _run(spark, tmp_path, lambda s: keyed.within_limit(s, most=4), *parts)
    seen, want = {}, {}
    for s, _, _, ts, k in sorted(rows, key=lambda r: (r[3], str(r[4]))):
        minute = (s, ts.replace(second=0))
        seen[minute] = seen.get(minute, 0) + 1
        want[k] = seen[minute] <= 4
    assert {int(r.id): r.accepted for r in got} == want


def test_debounce_equals_brute_force(spark, tmp_path):
    rng = random.Random(5)
    times = {key: sorted(rng.sample(range(3000), 40)) for key in "abc"}
    rows = sorted([(k, "", "", _at(t), n) for k, ts in times.items() for n, t in enumerate(ts)], key=lambda r: r[3])
    half = next(i for i in range(60, len(rows)) if rows[i][3] > rows[i - 1][3])
    want = set()
    for key, ts in times.items():
        opened, dirty = None, False
        for t in [*ts, 10**9]:
            if opened is None or t >= opened + 30:
                want |= {(key, _at(opened), _at(opened + 30), dirty)} if opened is not None else set()
                opened, dirty = t, False
            else:
                dirty = True
    for name, parts in (("one", [[*rows, END]]), ("two", [rows[:half], [*rows[half:], END]])):
        got = _run(spark, tmp_path / name, lambda s: keyed.debounced(s, "subscription"), *parts)
        assert {(r.key, r.opened, r.runs_at, r.dirty) for r in got} == want and len(got) == len(want)


def test_the_session_keeps_its_settings(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    with keyed.keyed_state(spark):
        assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
