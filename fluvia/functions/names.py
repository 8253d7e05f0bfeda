"""Names and literals: identifiers, file names, cursor literals."""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def identifier(name: str) -> str:
    """Lower snake case; a leading digit gets an underscore in front, trailing underscores an x."""
    split = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name.strip()))
    low = re.sub(r"_+", "_", re.sub(r"[^A-Za-z0-9_]+", "_", split)).lower()
    low = f"{low.rstrip('_')}x" if low.endswith("_") else low
    return f"_{low}" if low[:1].isdigit() else low


def table_name(source: str, resource: str, key: str, most: int = 63) -> str:
    """The landing table of a source's resource; a name that ``identifier`` would change, or a longer one, is refused."""
    name = identifier("_".join((source, resource, key)))
    if not name or identifier(name) != name:
        raise ValueError(f"{name!r} is no identifier")
    if len(name) > most:
        raise ValueError(f"{name!r} has more than {most} characters")
    return name


def digest(value: object) -> str:
    """A short hash of what JSON can say."""
    return hashlib.sha256(json.dumps(value).encode()).hexdigest()[:32]


def fingerprint(df: DataFrame) -> str:
    """A hash of the columns' names and types, whatever their order; reads the schema alone."""
    return digest(sorted((f.name, f.dataType.simpleString()) for f in df.schema))


def drift(was: DataFrame, now: DataFrame, mapped: list[str]) -> tuple[str, list[str]]:
    """(invalid, needs_review or ok, columns): mapped columns that are gone, or that have a sibling of another type."""
    gone = [c for c in mapped if c in was.columns and c not in now.columns]
    if gone:
        return "invalid", gone
    variants = [c for c in now.columns if c not in was.columns and "__v_" in c and c.split("__v_")[0] in mapped]
    return ("needs_review", variants) if variants else ("ok", [])


def is_file(path: Column) -> Column:
    """Whether the last part is ``name.ext`` with an extension that is not a number."""
    return F.element_at(F.split(path, "/"), -1).rlike(r"^[^?#]+\.(?![0-9]+$)[A-Za-z0-9]+$")


def cursor_literal(value: Column) -> Column:
    """A cursor's text as a literal in UTC, cut down to seconds; without a zone it is UTC already."""
    zoned = F.regexp_replace(value, r"([+-][0-9]{2})([0-9]{2})$", "$1:$2")
    at = F.date_trunc("second", zoned.try_cast("timestamp"))
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
