"""Ledgers of loads and runs as tables: what is landed, taken, claimed, and how it went.

A ledger of landing has (resource, load_id, status, created_at, ...), one of projections (load_ids, status, created_at).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .land import LOAD

# States of a run that hold its loads.
HOLDING = ("succeeded", "queued", "running")


def selected(resources: Mapping[str, DataFrame], names: Sequence[str] | None) -> dict[str, DataFrame]:
    """The named resources in their order; None is all of them, an unknown name an error."""
    if names is None:
        return dict(resources)
    if unknown := [n for n in names if n not in resources]:
        raise ValueError(f"no resource {', '.join(map(repr, unknown))}")
    return {n: df for n, df in resources.items() if n in names}


def outstanding(landed: DataFrame, runs: DataFrame, since: Column | None = None) -> DataFrame:
    """(load_id) of landed loads, from ``since`` on, that no run holds: neither taken nor about to be.

    ``runs`` has a row for each run and load (status, load_id), or one for each run (status, load_ids).
    """
    recent = landed if since is None else landed.where(F.col("created_at") >= since)
    load = F.col("load_id") if "load_id" in runs.columns else F.explode("load_ids")
    held = runs.where(F.col("status").isin(*HOLDING)).select(load.alias("load_id"))
    return recent.select("load_id").distinct().join(held.distinct(), "load_id", "left_anti")


def claimed(loads: DataFrame, ledger: DataFrame) -> DataFrame:
    """The load ids that an earlier run has claimed already; a run whose id is among them must not land."""
    return loads.select("load_id").distinct().join(ledger.select("load_id"), "load_id", "left_semi")


def row_counts(tables: Mapping[str, DataFrame], load: str | None = None) -> DataFrame:
    """(resource, load_id, rows) of landed tables, or of one of their loads."""
    out = None
    for name, df in tables.items():
        rows = df if load is None else df.where(F.col(LOAD) == load)
        one = rows.groupBy(F.col(LOAD).alias("load_id")).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("resource"), "load_id", "rows")
        out = one if out is None else out.unionAll(one)
    if out is None:
        raise ValueError("no tables")
    return out


def rolled_up(ledger: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many runs there are of each status, and when the last one was."""
    return ledger.groupBy(*by, "status").agg(F.count(F.lit(1)).alias("runs"), F.max("created_at").alias("last_at"))


def high_water(df: DataFrame, resource: str, cursor: str) -> DataFrame:
    """(resource, high, low, n): how far a cursor has come."""
    return df.agg(F.max(cursor).alias("high"), F.min(cursor).alias("low"), F.count(F.lit(1)).alias("n")).select(F.lit(resource).alias("resource"), "high", "low", "n")


def reset(states: DataFrame, binding: str, resources: Sequence[str] | None = None) -> DataFrame:
    """The states (binding, resource, cursor, ...) without those of one binding, or of some of its resources: they start over."""
    gone = F.col("binding") == binding
    return states.where(~F.coalesce(gone if resources is None else gone & F.col("resource").isin(list(resources)), F.lit(False)))


def backfilled(items: DataFrame, key: str, parked: object, most: int, watermark: object) -> tuple[DataFrame, dict]:
    """One run of a listing in order of ``key``: the next ``most`` items behind ``parked``, and the state to keep.

    ``watermark`` is what the source said before the listing began; it counts once the
    listing has come to its end, until then the last key is parked for the next run.
    """
    rest = items if parked is None else items.where(F.col(key) > F.lit(parked))
    page = rest.orderBy(key).limit(most)
    last, n = page.agg(F.max(key), F.count(F.lit(1))).first()
    more = bool(n) and not rest.where(F.col(key) > F.lit(last)).isEmpty()
    return page, {"parked": last, "watermark": None} if more else {"parked": None, "watermark": watermark}
