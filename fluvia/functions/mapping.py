"""The mapping language: JSON nodes to pairs of columns, a value and an error.

Nothing raises while rows run: a cast that fails gives a null value and a text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import casts
from .casts import MappingError, as_text

@dataclass(frozen=True)
class Cell:
    value: Column
    error: Column
    kind: T.DataType

    @classmethod
    def of(cls, value: Column, kind: T.DataType) -> Cell:
        return cls(value, F.lit(None).cast("string"), kind)


def cast(cell: Cell, name: str, **options: Any) -> Cell:
    """``cell`` as string, integer, decimal, float, boolean, datetime, date or json; null stays null.

    ``strip`` and ``decimal_separator`` apply to texts of numbers, ``format`` (a strptime
    pattern) and ``timezone`` to texts of times, ``max_length`` to strings.
    """
    casts.checked(name, options)
    out, kind = casts.value_of(cell.value, cell.kind, name, **options)
    out = out.cast(kind)
    shown = F.to_json(cell.value) if isinstance(cell.kind, (T.StructType, T.ArrayType, T.MapType)) else cell.value.cast("string")
    failed = F.when(cell.value.isNotNull() & out.isNull(), F.concat(F.lit(f"not {name}: "), shown))
    return Cell(out, F.coalesce(cell.error, failed), kind)


def _path(value: Column, path: str) -> Column:
    """A dotted path into JSON text: keys, or indices of lists, which count from the end where they are negative.

    The text is parsed once: a value that is itself JSON text isn't gone into.
    """
    parts = [p for p in path.split(".") if p]
    if not parts:
        return value
    found = F.try_parse_json(value)
    # A path of keys that are no numbers is one look-up; a number may be an index or a key, so each is a step.
    for part in parts:
        key = part.replace("\\", "\\\\").replace("'", "\\'")
        by_key = F.try_variant_get(found, f"$['{key}']", "variant")
        if re.fullmatch(r"-[0-9]+", part):
            items = F.try_variant_get(found, "$", "array<variant>")
            found = F.coalesce(F.when(F.size(items) >= -int(part), F.get(items, F.size(items) + int(part))), by_key)
        elif re.fullmatch(r"[0-9]+", part):
            found = F.coalesce(F.try_variant_get(found, f"$[{part}]", "variant"), by_key)
        else:
            found = by_key
    return F.try_variant_get(found, "$", "string")


#: What each form of a node may hold besides its name.
_KEYS = {"source": {"json_path", "default", "cast"}, "constant": set(), "object": set(), "function": {"args", "cast"}}


def compile_node(df: DataFrame, node: Mapping[str, Any], depth: int = 0) -> Cell:
    """One node of a mapping over the columns of ``df``."""
    if depth > 32:
        raise MappingError("mapping is nested too deeply")
    kinds = {f.name: f.dataType for f in df.schema}
    if not isinstance(node, Mapping):
        raise MappingError(f"a node is a mapping, not {node!r}")
    forms = [k for k in _KEYS if k in node]
    if len(forms) != 1:
        raise MappingError("a node has one of source, constant, object, function")
    options = {k: v for k, v in node.items() if k != forms[0] and k not in _KEYS[forms[0]]}
    if options and not ("cast" in node and "cast" in _KEYS[forms[0]]):
        raise MappingError(f"a {forms[0]} takes no {', '.join(sorted(options))}")
    if "constant" in node:
        value = node["constant"]
        if isinstance(value, (dict, list)):
            return Cell.of(F.lit(json.dumps(value)), T.StringType())
        kind = T.BooleanType() if isinstance(value, bool) else T.LongType() if isinstance(value, int) else T.DoubleType() if isinstance(value, float) else T.StringType()
        return Cell.of(F.lit(value).cast(kind), kind)
    if "object" in node:
        cells = {k: compile_node(df, v, depth + 1) for k, v in node["object"].items()}
        if not cells:
            raise MappingError("an object has fields")
        value = F.struct(*[c.value.alias(k) for k, c in cells.items()])
        return Cell(value, F.coalesce(*[c.error for c in cells.values()]), T.StructType([T.StructField(k, c.kind) for k, c in cells.items()]))
    if "source" in node:
        name = node["source"]
        if name not in kinds:
            if "default" not in node:
                raise MappingError(f"no column {name!r}")
            return compile_node(df, {"constant": node["default"]})
        cell = Cell.of(F.col(f"`{name}`"), kinds[name])
        if node.get("json_path"):
            cell = Cell.of(_path(F.col(f"`{name}`"), node["json_path"]), T.StringType())
        raw = cell
        if "cast" in node:
            cell = cast(cell, node["cast"], **options)
        if node.get("default") is not None:
            value = F.when(raw.value.isNull(), F.lit(node["default"]).cast(cell.kind)).otherwise(cell.value)
            cell = Cell(value, cell.error, cell.kind)
        return cell
    args = [compile_node(df, a, depth + 1) for a in node.get("args", ())]
    name = node["function"]
    if name in ("coalesce", "concat") and not args:
        raise MappingError(f"{name} takes arguments")
    if name == "coalesce":
        # Lazy: an argument's error counts only where all before it are null.
        value, error = F.lit(None).cast(args[0].kind), F.lit(None).cast("string")
        for a in reversed(args):
            value = F.when(a.error.isNotNull(), F.lit(None)).otherwise(F.coalesce(a.value, value))
            error = F.when(a.error.isNotNull(), a.error).when(a.value.isNotNull(), F.lit(None)).otherwise(error)
        cell = Cell(value, error, args[0].kind)
    elif name == "concat":
        cell = Cell(F.concat(*[F.coalesce(as_text(a.value, a.kind), F.lit("")) for a in args]), F.coalesce(*[a.error for a in args]), T.StringType())
    elif name in ("lower", "upper"):
        if len(args) != 1:
            raise MappingError(f"{name} takes one argument")
        text = as_text(args[0].value, args[0].kind)
        cell = Cell(F.lower(text) if name == "lower" else F.upper(text), args[0].error, T.StringType())
    else:
        raise MappingError(f"unknown function {name!r}")
    return cast(cell, node["cast"], **options) if "cast" in node else cell


def compile_mapping(df: DataFrame, mapping: Mapping[str, Mapping[str, Any]]) -> dict[str, Cell]:
    cells = {}
    for name, node in mapping.items():
        try:
            cells[name] = compile_node(df, node)
        except MappingError as e:
            raise MappingError(f"{name}: {e}") from e
    return cells


def source_columns(node: Mapping[str, Any]) -> set[str]:
    """The columns that a node, or all nodes of a mapping, read."""
    if "source" in node:
        return {node["source"]}
    inner = node["object"].values() if "object" in node else node.get("args", ()) if "function" in node else () if "constant" in node else node.values()
    return set().union(*map(source_columns, inner))


def coerced(cells: Mapping[str, Cell], fields: Mapping[str, Mapping[str, Any]]) -> dict[str, Cell]:
    """Cells as the target's ``fields`` (name to type and its options) take them, after their own casts."""
    if unknown := [n for n in cells if n not in fields]:
        raise MappingError(f"the target has no field {', '.join(map(repr, unknown))}")
    out = {}
    for name, cell in cells.items():
        field = {k: v for k, v in fields[name].items() if k not in ("required", "help_text")}
        out[name] = cast(cell, field.pop("type"), **field)
    return out


def _numeric(kind: T.DataType) -> bool:
    return isinstance(kind, (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.FloatType, T.DoubleType))


def loosely_equal(value: Column, kind: T.DataType, literal: Any) -> Column:
    """Truth values compare by truth, numbers with texts as numbers, like with like; nothing else is equal."""
    if isinstance(literal, bool) or isinstance(kind, T.BooleanType):
        truth = F.length(value) > 0 if isinstance(kind, T.StringType) else value.cast("boolean")
        return truth == F.lit(bool(literal))
    number = isinstance(literal, (int, float))
    if _numeric(kind) and number:
        return value == F.lit(literal)
    if isinstance(kind, T.DecimalType) and number:
        return value == F.lit(literal)
    if isinstance(kind, T.StringType) and number:
        return value.try_cast("double") == F.lit(float(literal))
    if _numeric(kind) and isinstance(literal, str):
        try:
            return value.cast("double") == F.lit(float(literal))
        except ValueError:
            return F.lit(False)
    if isinstance(kind, T.StringType) and isinstance(literal, str):
        return value == F.lit(literal)
    return F.lit(False)


def condition(df: DataFrame, field: str, op: str, literal: Any = None) -> Column:
    """One filter; a null value is false for all but the null checks."""
    kind = next((f.dataType for f in df.schema if f.name == field), None)
    if kind is None:
        raise MappingError(f"no column {field!r}")
    value = F.col(f"`{field}`")
    some = value.isNotNull()
    ordered = {"gt": "__gt__", "lt": "__lt__", "gte": "__ge__", "lte": "__le__"}
    if op == "is_null":
        return value.isNull()
    if op == "is_not_null":
        return some
    if op == "eq":
        out = loosely_equal(value, kind, literal)
    elif op == "ne":
        out = some & ~F.coalesce(loosely_equal(value, kind, literal), F.lit(False))
    elif op in ("in", "not_in"):
        any_of = F.lit(False)
        for one in literal:
            any_of = any_of | F.coalesce(loosely_equal(value, kind, one), F.lit(False))
        out = some & any_of if op == "in" else some & ~any_of
    elif op in ordered:
        comparable = (isinstance(literal, str) and isinstance(kind, T.StringType)) or (isinstance(literal, (int, float)) and (_numeric(kind) or isinstance(kind, (T.DecimalType, T.BooleanType))))
        left = value.cast("int") if isinstance(kind, T.BooleanType) else value
        out = getattr(left, ordered[op])(F.lit(literal)) if comparable else F.lit(False)
    elif op in ("contains", "startswith", "endswith"):
        out = getattr(F, op)(as_text(value, kind), F.lit(str(literal)))
    else:
        raise MappingError(f"unknown filter {op!r}")
    return F.coalesce(out, F.lit(False))


def all_of(df: DataFrame, filters: Sequence[Mapping[str, Any]]) -> Column:
    out = F.lit(True)
    for f in filters:
        out = out & condition(df, f["field"], f["op"], f.get("value"))
    return out
