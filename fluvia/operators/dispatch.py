"""Loads projected to a target exactly once, and targets that are written by a host's own code.

What a projection has taken stands in the commit that wrote it: a load is outstanding
until a version of the target has it, whatever happened in between.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.mapping import Cell
from ..sources import tables, versioned
from . import land, project, ranks
from .land import ROW

#: Loads of one run, rows of a batch, warnings that a run keeps.
MOST_LOADS, BATCH, MOST_WARNINGS = 1000, 500, 100


def outstanding(spark: SparkSession, landing: str, target: str) -> DataFrame:
    """(version, load_id) of landed loads that no version of the target has taken, by the two logs alone."""
    taken = versioned.ledger(spark, target).select(F.explode("taken").alias("load_id"))
    return versioned.ledger(spark, landing).select("version", "load_id").join(taken, "load_id", "left_anti")


def _projected(spark: SparkSession, rows: DataFrame, cells: Mapping[str, Cell], identity: Sequence[str], required: Sequence[str], filters: Column | None, policy: str) -> tuple[DataFrame, dict, list]:
    """(records, counts, warnings): rows are counted as they are written, bad ones noted or refused."""
    everything, passed = Observation(), Observation()
    counted = rows.observe(everything, F.count(F.lit(1)).alias("seen"))
    out = project.projected(counted, cells, identity, required, filters)
    out = out.observe(passed, F.count(F.lit(1)).alias("passed"), F.count_if(F.col("error").isNotNull()).alias("skipped"))
    path = tables.scratch(spark, "projected")
    out.write.parquet(path)
    every, some = versioned.observed(everything), versioned.observed(passed)
    counts = {"seen": every.get("seen") or 0, "filtered": (every.get("seen") or 0) - (some.get("passed") or 0), "skipped": some.get("skipped") or 0}
    written = spark.read.schema(out.schema).parquet(path)
    good = project.enforced(written, policy)
    bad = written.where("error is not null")
    told = [r.asDict() for r in project.warnings(bad, "error", ROW, MOST_WARNINGS).withColumnRenamed("error", "reason").orderBy(F.desc("n"), "reason").limit(MOST_WARNINGS).collect()] if counts["skipped"] else []
    return project.collapsed(good, identity), counts, told


def dispatched(
    spark: SparkSession, landing: str, target: str, cells: Callable[[DataFrame], Mapping[str, Cell]], identity: Sequence[str], run: str, required: Sequence[str] = (),
    filters: Callable[[DataFrame], Column] | None = None, policy: str = "skip", most: int = MOST_LOADS, full: bool = False,
) -> dict:
    """Project the ``most`` oldest outstanding loads into ``target`` in one commit; returns its counts (seen, filtered, skipped, written, deleted), or none where nothing is outstanding.

    A run that stopped before its commit has taken nothing, one that is repeated after it finds nothing
    outstanding, and of two runs at once the later fails to commit a load that the other took.  ``full``:
    all that is landed, whichever loads it came by, in place of all that the target holds.
    """
    loads = [r.load_id for r in outstanding(spark, landing, target).orderBy("version").limit(most).collect()]
    if not loads and not full:
        return {}
    landed = versioned.table(spark, landing)
    rows = land.in_loads(landed, None if full else loads)
    records, counts, warnings = _projected(spark, rows, cells(landed), identity, required, filters(landed) if filters else None, policy)
    names = [f.name for f in records.schema["values"].dataType]
    flat = records.select("values.*", (F.col("operation") == "delete").alias("_delete"))
    entry = {"taken": loads, "counts": counts, "warnings": warnings}
    version = versioned.merge(flat.select(*names, "_delete"), target, run, run, gone="_delete", whole=full, entry=entry)
    load = version.load
    return {**counts, "written": load["rows"] - load["tombstones"], "deleted": load["tombstones"]}


@dataclass
class Result:
    """What a writer says of a batch; None means that it did all that it was given."""

    written: int | None = None
    deleted: int | None = None
    skipped: int = 0
    warnings: Sequence[str] = ()


@dataclass(frozen=True)
class Context:
    """``run`` and ``batch_index`` name a batch for good: a writer that has done it may say so again."""

    run: str
    batch_index: int
    replace_scope: bool = False


Writer = Callable[[list[dict], Context], Result | int | None]

_OUTCOME = "batch_index long, written long, deleted long, skipped long, warnings array<string>"


def delivered(records: DataFrame, writer: Writer, identity: Sequence[str], run: str, size: int = BATCH, replace_scope: bool = False) -> DataFrame:
    """Give ``records`` (operation, values) to ``writer``, ``size`` to a batch, and return what became of each batch.

    Batches go by identity, upserts before deletions, so that a run repeated makes the same ones.
    A batch is one task's; a task that is lost is tried again with the same batches and contexts, and only what a
    task ended with counts.  The outcomes are written before they are returned: the writer is called
    when this is, and not again when they are read.
    """
    spark = records.sparkSession
    keys = [f"_k{n}" for n in range(len(identity))]
    named = records.select((F.col("operation") == "delete").alias("_last"), *[F.col("values")[c].alias(k) for c, k in zip(identity, keys)], "operation", F.to_json("values", {"ignoreNullFields": "false"}).alias("_json"))
    placed = ranks.ranked(named, ["_last", *keys], "_place").withColumn("batch_index", F.expr(f"_place div {int(size)}"))

    def write(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("_place")
        kinds = group.column("operation").to_pylist()
        batch = []
        for kind, text in zip(kinds, group.column("_json").to_pylist(), strict=True):
            values = json.loads(text)
            batch.append({"operation": kind, "identity": {c: values[c] for c in identity}, "values": values if kind == "upsert" else {}})
        result = writer(batch, Context(run, key[0].as_py(), replace_scope))
        result = result if isinstance(result, Result) else Result()
        up = kinds.count("upsert")
        written, deleted = up if result.written is None else result.written, len(kinds) - up if result.deleted is None else result.deleted
        row = [[key[0].as_py()], [written], [deleted], [result.skipped], [[str(w) for w in result.warnings]]]
        return pa.table([pa.array(v, t) for v, t in zip(row, (pa.int64(),) * 4 + (pa.list_(pa.string()),))], names=["batch_index", "written", "deleted", "skipped", "warnings"])

    path = tables.scratch(spark, "delivered")
    placed.groupBy("batch_index").applyInArrow(write, _OUTCOME).write.parquet(path)
    return spark.read.schema(_OUTCOME).parquet(path)


def totals(outcomes: DataFrame, most: int = MOST_WARNINGS) -> dict:
    """written, deleted and skipped of all batches, and the ``most`` first warnings in the order of batches."""
    total = outcomes.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("written", "deleted", "skipped")]).first()
    some = outcomes.select("batch_index", F.posexplode("warnings").alias("at", "warning")).orderBy("batch_index", "at").limit(most)
    return {**total.asDict(), "warnings": [r.warning for r in some.collect()]}
