"""Checks of landed tables, resources and projections, and previews."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import mapping
from ..functions.mapping import Cell
from . import pages
from .land import BINDING, DELETED, LOAD, ROW, STAMPS
from .project import projected

# The ways in which a resource is written.
DISPOSITIONS = ("merge", "append", "replace")


#: Bytes of a preview's entries.
PREVIEW_BYTES = 1 << 20


def preview(
    df: DataFrame, cells: Mapping[str, Cell], identity: Sequence[str], required: Sequence[str] = (), filters: Column | None = None, limit: int | None = pages.MOST, most_bytes: int = PREVIEW_BYTES
) -> DataFrame:
    """status (ok, filtered or error), source without internal columns, deleted, record, error and truncated of the first rows in load order; nothing is written.

    ``limit``: how many rows a preview shows, of so many bytes that its budget is used up at the last of them, which
    then is marked as truncated.  None shows all, in no order.
    """
    rows = df if limit is None else pages.in_load_order(df).limit(max(0, min(limit, pages.MOST)))
    source = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in STAMPS])
    passes = F.lit(True) if filters is None else F.coalesce(filters, F.lit(False))
    kept = rows.withColumn("_source", source).withColumn("_passes", passes)
    out = projected(kept, cells, identity, required, carried=("_source", "_passes", DELETED))
    status = F.when(~F.col("_passes"), "filtered").when(F.col("error").isNotNull(), "error").otherwise("ok")
    record = F.when(status == "ok", F.struct("operation", "values"))
    told = out.select(LOAD, ROW, status.alias("status"), F.col("_source").alias("source"), F.coalesce(F.col(DELETED), F.lit(False)).alias("deleted"), record.alias("record"), F.when(status == "error", F.col("error")).alias("error"))
    if limit is None:
        return told.drop(LOAD, ROW).withColumn("truncated", F.lit(False))
    entry = F.to_json(F.struct("status", "source", "deleted", "record", "error"))
    return pages.within_budget(told, [LOAD, ROW], entry, most_bytes).drop(LOAD, ROW)


def preview_counts(previewed: DataFrame) -> dict:
    """How many rows a preview shows, and how many of each status."""
    row = previewed.agg(F.count(F.lit(1)).alias("row_count"), *[F.count_if(F.col("status") == s).alias(f"{s}_count") for s in ("ok", "filtered", "error")]).first()
    return row.asDict()


def landing_counts(df: DataFrame, binding: str) -> DataFrame:
    """One row: rows, rows without a stamp and rows of other tenants."""
    missing = [c for c in STAMPS if c not in df.columns]
    if missing:
        raise ValueError(f"the landed table lacks {', '.join(missing)}")
    unstamped = F.greatest(*[F.col(c).isNull() for c in STAMPS])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(unstamped).alias("unstamped"), F.count_if(F.col(BINDING) != binding).alias("foreign_rows"))


def tombstone_counts(df: DataFrame, key: Sequence[str], cursor: str | None = None) -> DataFrame:
    """One row: tombstones, those without a whole key, and those that hold more than key and cursor."""
    others = [c for c in df.columns if c not in (*key, cursor, *STAMPS)]
    keyless = F.greatest(*[F.col(k).isNull() for k in key], F.lit(False))
    extra = F.greatest(*[F.col(c).isNotNull() for c in others], F.lit(False), F.lit(False))
    return df.where(F.col(DELETED)).agg(F.count(F.lit(1)).alias("tombstones"), F.count_if(keyless).alias("keyless"), F.count_if(extra).alias("with_values"))


def resource_problems(disposition: str, key: Sequence[str] = (), cursor: str | None = None, columns: Sequence[str] | None = None) -> list[str]:
    """What is wrong with how a resource is declared."""
    out = [] if disposition in DISPOSITIONS else [f"unknown disposition {disposition!r}"]
    if disposition == "merge" and not key:
        out.append("a merge needs a key")
    if disposition == "append" and key:
        out.append("an append takes no key")
    if columns is not None:
        out += [f"no column {c!r}" for c in (*key, *([cursor] if cursor else [])) if c not in columns]
    return out


def projection_problems(
    df: DataFrame, nodes: Mapping[str, Mapping[str, Any]], fields: Mapping[str, str], identity: Sequence[str], required: Sequence[str] = (), key: Sequence[str] = (), tombstones: bool = False,
    filters: Sequence[Mapping[str, Any]] = (),
) -> tuple[list[str], list[str]]:
    """Errors and warnings of a mapping and its filters against a target's ``fields`` (name to type); reads the schema alone."""
    errors = [f"the target has no field {n!r}" for n in nodes if n not in fields]
    errors += [f"{n!r} is required and not mapped" for n in dict.fromkeys((*identity, *required)) if n not in nodes]
    warnings: list[str] = []
    for name, node in nodes.items():
        try:
            cell = mapping.compile_node(df, node)
        except mapping.MappingError as problem:
            errors.append(f"{name}: {problem}")
            continue
        kind = cell.kind.simpleString()
        if name in identity and kind.startswith(("struct", "array", "map")):
            errors.append(f"{name}: an identity is one value")
        if name in fields and kind != fields[name]:
            warnings.append(f"{name}: {kind} goes into {fields[name]}")
    for one in filters:
        try:
            mapping.condition(df, one.get("field"), one.get("op"), one.get("value"))
        except (mapping.MappingError, TypeError) as problem:
            errors.append(f"filter on {one.get('field')!r}: {problem}")
    used = set().union(*[mapping.source_columns(n) for n in nodes.values() if isinstance(n, Mapping)], {f.get("field") for f in filters})
    for name in sorted(c for c in used if c):
        variants = [c for c in df.columns if c.startswith(f"{name}__v_")]
        if variants:
            warnings.append(f"{name}: some of its values are in {', '.join(variants)}")
    if tombstones and key:
        sources = {n: nodes[n].get("source") for n in identity if n in nodes}
        errors += [f"{n}: a deleted row has no {s!r}, which is outside the merge key" for n, s in sources.items() if s not in key]
        if set(sources.values()) < set(key):
            warnings.append("the identity is coarser than the merge key: several rows may be one record")
    return errors, warnings


def graded(problems: tuple[list[str], list[str]], before: str = "active") -> str:
    """The status of a projection with these errors and warnings: invalid, needs_review, or active (again); a draft stays one."""
    errors, warned = problems
    return "draft" if before == "draft" else "invalid" if errors else "needs_review" if warned else "active"


def regraded(df: DataFrame, projections: Mapping[str, Mapping[str, Any]]) -> dict[str, tuple[str, list[str]]]:
    """Status and messages of every projection (name to status, nodes, filters, fields, identity, required) of a resource after its table's schema has changed."""
    out = {}
    for name, p in projections.items():
        problems = projection_problems(df, p["nodes"], p["fields"], p["identity"], p.get("required", ()), filters=p.get("filters", ()))
        out[name] = (graded(problems, p.get("status", "active")), [*problems[0], *problems[1]])
    return out
