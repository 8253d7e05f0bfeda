"""Projection: mapped rows with errors as values, collapsed to one operation for each identity, written to a target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.mapping import Cell
from .land import DELETED, LOAD, ROW


class InvalidRecord(ValueError):
    """A row that can't be projected, under the policy that lets none be skipped."""


def projected(df: DataFrame, cells: Mapping[str, Cell], identity: Sequence[str], required: Sequence[str] = (), filters: Column | None = None, carried: Sequence[str] = ()) -> DataFrame:
    """operation, values, error and load order of every row that the filters let through.

    A deleted row evaluates its identity alone.  The first failing check is the row's
    error: casts in order, then a null identity, then a missing required value.  ``carried``: columns of ``df`` that go along.
    """
    rows = df if filters is None else df.where(filters)
    deleted = F.coalesce(F.col(DELETED), F.lit(False))
    values = F.struct(*[F.when(~deleted | F.lit(name in identity), cell.value).alias(name) for name, cell in cells.items()])
    checks = [F.when(~deleted | F.lit(name in identity), F.when(cell.error.isNotNull(), F.concat(F.lit(f"{name}: "), cell.error))) for name, cell in cells.items()]
    checks += [F.when(cells[name].value.isNull(), F.lit(f"{name}: identity is null")) for name in identity]
    checks += [F.when(~deleted & cells[name].value.isNull(), F.lit(f"{name}: required")) for name in required]
    return rows.select(F.when(deleted, "delete").otherwise("upsert").alias("operation"), values.alias("values"), F.coalesce(*checks).alias("error"), LOAD, ROW, *carried)


def collapsed(df: DataFrame, identity: Sequence[str]) -> DataFrame:
    """One row for each identity: a delete if there is any, else the newest upsert by load and row."""
    good = df.where("error is null").select(*[F.col("values")[k].alias(f"_k_{k}") for k in identity], "*")
    keys = [f"_k_{k}" for k in identity]
    best = good.groupBy(*keys).agg(F.max_by("values", F.struct(LOAD, ROW)).alias("values"), F.bool_or(F.col("operation") == "delete").alias("_gone"))
    return best.select(F.when(F.col("_gone"), "delete").otherwise("upsert").alias("operation"), "values")


def counts(df: DataFrame) -> DataFrame:
    """seen, ok and skipped rows of a projection."""
    return df.agg(F.count(F.lit(1)).alias("seen"), F.count_if(F.col("error").isNull()).alias("ok"), F.count_if(F.col("error").isNotNull()).alias("skipped"))


def written(target: DataFrame, records: DataFrame, identity: Sequence[str]) -> DataFrame:
    """The target after the records: upserted rows replaced, deleted ones gone."""
    keys = records.select(*[F.col("values")[k].alias(k) for k in identity])
    return target.join(keys, list(identity), "left_anti").unionByName(records.where("operation = 'upsert'").select("values.*"))


def replaced(target: DataFrame, records: DataFrame, owner: Sequence[str], owners: DataFrame | None = None) -> DataFrame:
    """The target with all records of the replayed owners replaced by ``records``.

    ``owners`` names those that were replayed; one whose replay is empty keeps nothing.
    Without it they are the owners in ``records``.
    """
    gone = (owners.select(*owner) if owners is not None else records.select(*[F.col("values")[k].alias(k) for k in owner])).distinct()
    return target.join(gone, list(owner), "left_anti").unionByName(records.where("operation = 'upsert'").select("values.*"))


def enforced(df: DataFrame, policy: str = "skip") -> DataFrame:
    """The good rows of a projection.  ``fail``: the first bad row, in load order, stops the run before anything is written."""
    if policy not in ("fail", "skip"):
        raise ValueError(f"no policy {policy!r}")
    if policy == "fail":
        first = df.where("error is not null").select(F.struct(LOAD, ROW, "error").alias("x")).agg(F.min("x")).first()[0]
        if first is not None:
            raise InvalidRecord(f"load {first[LOAD]}, row {first[ROW]}: {first['error']}")
    return df.where("error is null")


def warnings(df: DataFrame, reason: str, row: str, most: int = 100) -> DataFrame:
    """(reason, n, rows): every row is counted, the ``most`` lowest of each reason are shown.

    A reason's rows are listed in 64 parts of each partition, each cut to ``most`` before the parts meet, so a common reason is never whole in one task.
    """
    part = df.groupBy(reason, F.spark_partition_id().alias("_p"), (F.xxhash64(row) % 64).alias("_s"))
    some = part.agg(F.count(F.lit(1)).alias("n"), F.slice(F.sort_array(F.collect_list(row)), 1, most).alias("rows"))
    return some.groupBy(reason).agg(F.sum("n").alias("n"), F.slice(F.sort_array(F.flatten(F.collect_list("rows"))), 1, most).alias("rows"))
