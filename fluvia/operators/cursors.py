"""Where a resource has been read to: cursors that advance with the commit that landed what they stand for, and tokens of feeds."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import versioned
from . import land


def last_value(spark: SparkSession, root: str, kind: str) -> Any:
    """The highest cursor of all committed loads, as a value of type ``kind``; None before the first."""
    return versioned.ledger(spark, root).agg(F.max(F.col("high").cast(kind)).alias("high")).first().high


def landed_since(df: DataFrame, root: str, load: str, cursor: str, order: Sequence[Column] = (), binding: str | None = None, run: str | None = None) -> versioned.Version:
    """Land what ``df`` has at or past the last cursor, and rows without one, the newest of each key.

    The cursor is noted in the load's own commit: a load that fails leaves it where it was, and
    the next one reads the same rows again.
    """
    spark = df.sparkSession
    now = versioned.current(spark, root)
    kind = df.schema[cursor].dataType.simpleString()
    fresh = land.incremental(df, cursor, last_value(spark, root, kind))
    newest = land.newest(fresh, list(now.key), [F.col(cursor), *order])
    if binding is not None:
        newest = land.stamped(newest, binding, run or load, load)
    return versioned.merge(newest, root, load, run, cursor=cursor)


def scope_mark(scope: Mapping[str, Any]) -> str:
    """What tells two scopes of a feed (folder, drive, glob) apart, whatever their order."""
    return hashlib.sha256(json.dumps(scope, sort_keys=True, default=str).encode()).hexdigest()[:32]


def token(states: DataFrame, binding: str, resource: str, scope: Mapping[str, Any]) -> str | None:
    """The feed's token in ``states`` (binding, resource, scope, token); None where it was for another scope, so that the feed starts over."""
    row = states.where((F.col("binding") == binding) & (F.col("resource") == resource) & (F.col("scope") == scope_mark(scope))).agg(F.max("token").alias("token")).first()
    return row.token


def with_token(states: DataFrame, binding: str, resource: str, scope: Mapping[str, Any], value: str) -> DataFrame:
    """``states`` after a run that ended with ``value``: one token for each resource of a binding."""
    spark = states.sparkSession
    others = states.where(~((F.col("binding") == binding) & (F.col("resource") == resource)))
    return others.unionByName(spark.createDataFrame([(binding, resource, scope_mark(scope), value)], "binding string, resource string, scope string, token string"))
