"""Landing: stamps, deduplication within a load, merges, schema evolution, scopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import casts

BINDING, RUN, DELETED, LOAD, ROW = "_connector_binding_id", "_connector_run_id", "_connector_deleted", "_load_id", "_row_id"
STAMPS = (BINDING, RUN, DELETED, LOAD, ROW)


_JSON = "json_of"


def nested_to_json(df: DataFrame) -> DataFrame:
    """Structs, arrays and maps land as JSON text; the column's metadata keeps the type, by which ``decoded`` reads it back."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*[F.to_json(F.col(f"`{f.name}`")).alias(f.name, metadata={_JSON: f.dataType.simpleString()}) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in df.schema])


def decoded(df: DataFrame) -> DataFrame:
    """Columns that landed as JSON in their type again; a text that doesn't parse is kept beside them, in ``column__v_string``."""
    columns: list[Column] = []
    for f in df.schema:
        value = F.col(f"`{f.name}`")
        if _JSON not in f.metadata or not isinstance(f.dataType, T.StringType):
            columns.append(value)
            continue
        parsed = F.from_json(value, f.metadata[_JSON], {"mode": "PERMISSIVE"})
        whole = casts.is_json(value)
        columns += [F.when(whole, parsed).alias(f.name), F.when(value.isNotNull() & ~whole, value).alias(f"{f.name}__v_string")]
    return df.select(*columns)


def enforced(df: DataFrame) -> DataFrame:
    """``df`` as it is; a row without one of the stamps it should have stops the job that writes it, before anything is committed."""

    def sure(name: str) -> Column:
        problem = F.raise_error(F.concat(F.lit("a row of load "), F.coalesce(F.col(LOAD).cast("string") if LOAD in df.columns else F.lit(None), F.lit("?")), F.lit(f" has no {name}")))
        return F.when(F.col(name).isNotNull(), F.col(name)).otherwise(problem.cast(df.schema[name].dataType)).alias(name)

    return df.select(*[sure(c) if c in STAMPS else F.col(f"`{c}`") for c in df.columns])


def stamped(df: DataFrame, binding: str, run: str, load: str) -> DataFrame:
    """Tenant, run and load on every row; a missing deletion flag is false; the row id is a hash of the row."""
    own = [c for c in df.columns if c not in STAMPS]
    deleted = F.coalesce(F.col(DELETED), F.lit(False)) if DELETED in df.columns else F.lit(False)
    row = F.sha2(F.to_json(F.struct(*own, deleted.alias(DELETED))), 256)
    return df.select(*own, F.lit(binding).alias(BINDING), F.lit(run).alias(RUN), deleted.alias(DELETED), F.lit(load).alias(LOAD), row.alias(ROW))


def newest(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each key: the first in ``order``.  Rows with a null in the key all stay.

    A hash aggregate of one struct: rows are combined before the shuffle, so a
    hot key costs no more than any other.
    """
    known = F.expr(" and ".join(f"`{k}` is not null" for k in key))
    best = df.where(known).groupBy(*key).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_best")).select("_best.*")
    return best.unionByName(df.where(~known))


def merge_key(key: Sequence[str], *tables: DataFrame) -> list[str]:
    """``key`` behind the tenant, where the tables have one: equal ids of two tenants are two rows."""
    return [BINDING, *[k for k in key if k != BINDING]] if all(BINDING in t.columns for t in tables) else list(key)


def merged(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Delete the rows whose key is in ``new``, insert ``new``.  The tenant leads every key.  A null key matches nothing."""
    whole = merge_key(key, old, new)
    keys = new.select(*whole).distinct()
    return old.join(keys, whole, "left_anti").unionByName(new, allowMissingColumns=True)


def incremental(df: DataFrame, cursor: str, last: object) -> DataFrame:
    """Rows at or past the last cursor, and those without one."""
    return df if last is None else df.where((F.col(cursor) >= F.lit(last)) | F.col(cursor).isNull())


def evolved(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with one schema.  Where a column's type changed, values that the old one can't hold as they are go to ``column__v_type``."""
    types = {f.name: f.dataType for f in old.schema}
    columns: list[Column] = []
    for field in new.schema:
        was = types.get(field.name)
        if was is None or was == field.dataType:
            columns.append(F.col(field.name))
            continue
        cast = F.col(field.name).try_cast(was)
        # 1.7 doesn't go into a whole number: what is cast must come back the same.  A text is refused or read by the cast itself.
        kept = cast if isinstance(field.dataType, T.StringType) else F.when(cast.try_cast(field.dataType) == F.col(field.name), cast)
        columns += [kept.alias(field.name), F.when(kept.isNull(), F.col(field.name)).alias(f"{field.name}__v_{field.dataType.simpleString()}")]
    shaped = new.select(*columns)
    names = [*old.columns, *[c for c in shaped.columns if c not in old.columns]]

    def with_all(df: DataFrame) -> DataFrame:
        have = set(df.columns)
        kinds = {f.name: f.dataType for f in (*shaped.schema, *old.schema)}
        return df.select(*[F.col(c) if c in have else F.lit(None).cast(kinds[c]).alias(c) for c in names])

    return with_all(old), with_all(shaped)


def in_loads(df: DataFrame, loads: Sequence[str] | None) -> DataFrame:
    """The rows of these loads; None is the whole table, an empty list nothing."""
    return df if loads is None else df.where(F.col(LOAD).isin(list(loads))) if loads else df.where(F.lit(False))


def outstanding(landed: DataFrame, done: DataFrame) -> DataFrame:
    """Loads of ``landed`` that no run in ``done`` has taken."""
    return landed.select("load_id").distinct().join(done.select("load_id").distinct(), "load_id", "left_anti")


def landed_references(rows: DataFrame, landed: DataFrame, column: str, key: str) -> DataFrame:
    """The rows whose ``column`` names a landed row; Spark picks a broadcast or a shuffle by the sizes."""
    return rows.join(landed.select(F.col(key).alias(column)).distinct(), column, "left_semi")


def landing_schema(df: DataFrame, resource: str) -> list[dict]:
    """name, type, nullable and variant_of of each column of a landed table, from its schema alone."""
    known = set(df.columns)
    return [{"resource": resource, "name": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable, "variant_of": base if (base := f.name.split("__v_")[0]) != f.name and base in known else None, "internal": f.name in STAMPS} for f in df.schema]


def foreign_rows(df: DataFrame, binding: str) -> DataFrame:
    """How many rows belong to another tenant (a null is allowed)."""
    return df.agg(F.count_if(F.col(BINDING) != binding).alias("foreign_rows"))


def by_window(df: DataFrame, key: Sequence[str], ts: str, tie: str, width: str, most: int) -> DataFrame:
    """The first ``most`` rows of each key in each tumbling window, marked ``accepted``."""
    window = Window.partitionBy(*key, F.window(ts, width)).orderBy(ts, tie)
    return df.withColumn("accepted", F.row_number().over(window) <= most)
