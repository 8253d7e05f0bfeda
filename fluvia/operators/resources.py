"""A source's declared resources landed table by table, what their columns are by now, and how they are dropped.

Each resource of a binding has its own versioned table, ``base/{source}_{resource}_{landing_key}``.
Columns land under stable names and nested ones as JSON; how a resource is written is checked
before any of them is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..sources import versioned
from . import checks, land, ledger


@dataclass(frozen=True)
class Resource:
    """``rows`` and how they are written; ``key`` and ``cursor`` are named as the source names them.

    ``merge`` (which is meant where nothing is said) replaces rows by their key, ``append`` keeps what is there and takes no key,
    ``replace`` makes the table anew.  ``order``: which of a load's rows with one key is newest; the cursor by default.
    """

    rows: DataFrame
    key: Sequence[str] = ()
    disposition: str | None = None
    cursor: str | None = None
    order: Sequence[Column] = ()


def of_sheet(rows: DataFrame, key: str | None = None) -> Resource:
    """A sheet's rows: merged by the key column, or without one replaced as a whole."""
    return Resource(rows, (key,), "merge") if key else Resource(rows, disposition="replace")


def shaped(df: DataFrame) -> DataFrame:
    """Columns by their stable names, nested ones as JSON; two that would get one name are an error."""
    new = [c if c in land.STAMPS else names.identifier(c) for c in df.columns]
    twice = [n for n, k in Counter(new).items() if k > 1]
    if twice:
        raise ValueError("columns become one: " + "; ".join(f"{n} from {', '.join(repr(c) for c, m in zip(df.columns, new) if m == n)}" for n in twice))
    flat = land.nested_to_json(df)
    return flat.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(flat.columns, new)])


def root_of(base: str, source: str, resource: str, landing_key: str) -> str:
    return f"{base}/{names.table_name(source, resource, landing_key)}"


def problems(resources: Mapping[str, Resource]) -> list[str]:
    """What is wrong with how the resources are declared, each with its name."""
    return [f"{name}: {p}" for name, r in resources.items() for p in checks.resource_problems(r.disposition or "merge", r.key, r.cursor, r.rows.columns)]


def land_source(
    spark: SparkSession, base: str, source: str, landing_key: str, resources: Mapping[str, Resource], binding: str, run: str, load: str, only: Sequence[str] | None = None, buckets: int = versioned.BUCKETS
) -> dict[str, versioned.Version]:
    """Land the resources, or ``only`` those named, each in one commit of its own table; nothing is written where one is declared wrong.

    A load repeated after a failure lands what is missing: tables that have it stay as they are.
    """
    chosen = {n: resources[n] for n in ledger.selected({n: r.rows for n, r in resources.items()}, only)}
    if wrong := problems(chosen):
        raise ValueError("; ".join(wrong))
    plans = {n: (root_of(base, source, n, landing_key), shaped(r.rows)) for n, r in chosen.items()}
    out = {}
    for name, (root, rows) in plans.items():
        r = chosen[name]
        key, cursor = [names.identifier(k) for k in r.key], names.identifier(r.cursor) if r.cursor else None
        rows = land.stamped(rows, binding, run, load)
        if not versioned.exists(spark, root):
            versioned.create(spark, root, key or [land.ROW], buckets)
        have = versioned.current(spark, root).key
        if have != tuple(key or [land.ROW]):
            raise ValueError(f"{name}: its table goes by {', '.join(have)}")
        if r.disposition == "append":
            out[name] = versioned.append(rows, root, load, run, cursor)
        elif r.disposition == "replace":
            out[name] = versioned.merge(rows, root, load, run, cursor=cursor, whole=True)
        else:
            order = list(r.order) or ([F.col(cursor)] if cursor else [])
            out[name] = versioned.merge(land.newest(rows, key, [*order, F.col(land.ROW)]), root, load, run, cursor=cursor)
    return out


def landed_schema(spark: SparkSession, base: str, source: str, landing_key: str, resources: Sequence[str]) -> dict[str, Any]:
    """Status, table and columns of the resources that have been landed, and a fingerprint of them all; by the logs alone.

    Before the first load the status is ``pending_first_run`` and there is nothing else.
    """
    tables = {}
    for name in resources:
        root = root_of(base, source, name, landing_key)
        if versioned.exists(spark, root) and (version := versioned.current(spark, root)).schema is not None:
            tables[name] = spark.createDataFrame([], version.schema)
    if not tables:
        return {"status": "pending_first_run", "resources": {}, "fingerprint": ""}
    columns = {n: [c for c in land.landing_schema(df, n) if not c["internal"]] for n, df in tables.items()}
    prints = sorted((n, names.fingerprint(df)) for n, df in tables.items())
    whole = prints[0][1] if len(prints) == 1 else names.digest(prints)
    return {"status": "ready", "resources": {n: {"table": names.table_name(source, n, landing_key), "columns": c} for n, c in columns.items()}, "fingerprint": whole}


def regraded(spark: SparkSession, root: str, projections: Mapping[str, Mapping[str, Any]]) -> list[tuple[int, str | None, dict[str, tuple[str, list[str]]]]]:
    """(version, load, status and messages of each projection) for every load that changed the table's columns."""
    return [(number, load, checks.regraded(spark.createDataFrame([], schema), projections)) for number, load, schema in versioned.history(spark, root)]


def variant_counts(df: DataFrame) -> dict[str, int]:
    """How many values lie beside each column, in one of another type; one pass over those columns alone."""
    beside = [c for c in df.columns if "__v_" in c and c.split("__v_")[0] in df.columns]
    if not beside:
        return {}
    return df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in beside]).first().asDict()


def purge(spark: SparkSession, base: str, source: str, landing_key: str, resources: Sequence[str]) -> list[str]:
    """Delete a binding's tables with their cursors and schemas, and tell their names; other bindings' tables stay.

    Every table of the binding that lies below ``base`` goes, whether its resource is still declared or not.
    """
    prefix, suffix = f"{names.identifier(source)}_", f"_{landing_key}"
    expected = {names.table_name(source, r, landing_key) for r in resources}
    found = expected | {n for n in versioned.folders(spark, base) if n.startswith(prefix) and n.endswith(suffix)}
    gone = versioned.purge(spark, [f"{base}/{n}" for n in sorted(found)])
    return [g.rsplit("/", 1)[-1] for g in gone]
