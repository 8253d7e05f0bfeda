"""Casts with errors as values, written so that nothing raises while rows run.

Texts are taken apart by regular expressions and put together as ISO texts, which
``try_cast`` reads or refuses; formats are ``strptime`` patterns, checked when they
are compiled.
"""

from __future__ import annotations

import re
import zoneinfo
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that are truth values.
TRUE, FALSE = ("true", "t", "yes", "y", "1", "on"), ("false", "f", "no", "n", "0", "off", "")

# Casts and the options that each takes.
OPTIONS = {
    "string": ("max_length",), "integer": ("strip", "decimal_separator"), "decimal": ("strip", "decimal_separator"), "float": ("strip", "decimal_separator"),
    "boolean": (), "datetime": ("format", "timezone"), "date": ("format",), "json": (),
}

# The parts of a date or time that a directive stands for, and how each is written.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
DIRECTIVES = {
    "d": r"3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9]", "m": r"1[0-2]|0[1-9]|[1-9]", "Y": r"[0-9]{4}", "y": r"[0-9]{2}",
    "H": r"2[0-3]|[01][0-9]|[0-9]", "I": r"1[0-2]|0[1-9]|[1-9]", "M": r"[0-5][0-9]|[0-9]", "S": r"6[01]|[0-5][0-9]|[0-9]", "f": r"[0-9]{1,6}", "p": r"am|pm",
    "b": "|".join(m[:3] for m in MONTHS), "B": "|".join(MONTHS), "a": "|".join(d[:3] for d in DAYS), "A": "|".join(DAYS),
    "j": r"36[0-6]|3[0-5][0-9]|[12][0-9]{2}|0[1-9][0-9]|00[1-9]|[1-9][0-9]|0[1-9]|[1-9]", "z": r"Z|[+-][0-9]{2}:?[0-9]{2}", "Z": r"utc|gmt", "w": r"[0-6]", "u": r"[1-7]",
}
COMPOSED = {"c": "%a %b %d %H:%M:%S %Y", "x": "%m/%d/%y", "X": "%H:%M:%S"}
#: Weeks count from a year's first one; no ISO text has them.
REFUSED = "GUVW"

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_OFFSET = r"(Z|[+-][0-9]{2}:?[0-9]{2})"
_ISO_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
_ISO = rf"^{_ISO_DATE}([T ][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}([.,][0-9]{{1,6}})?)?{_OFFSET}?)?$"


class MappingError(ValueError):
    """A mapping or filter that can't be compiled; never skipped."""


def checked(name: Any, options: Mapping[str, Any]) -> None:
    """Refuse an unknown cast, an option that it doesn't take, or a value that the option can't have."""
    if not isinstance(name, str) or name not in OPTIONS:
        raise MappingError(f"unknown cast {name!r}: there are {', '.join(OPTIONS)}")
    if unknown := sorted(set(options) - set(OPTIONS[name])):
        raise MappingError(f"cast {name!r} takes no {', '.join(unknown)}")
    strip, separator, most = options.get("strip", ""), options.get("decimal_separator", "."), options.get("max_length")
    if not isinstance(strip, str):
        raise MappingError("strip is a text of characters")
    if separator not in (".", ","):
        raise MappingError("decimal_separator is . or ,")
    if separator in strip:
        raise MappingError(f"strip would remove {separator!r}, the decimal separator")
    if most is not None and (isinstance(most, bool) or not isinstance(most, int) or most < 0):
        raise MappingError("max_length is a whole number")
    if (zone := options.get("timezone")) is not None:
        try:
            zoneinfo.ZoneInfo(zone)
        except (zoneinfo.ZoneInfoNotFoundError, ValueError, TypeError, OSError) as e:
            raise MappingError(f"no time zone {zone!r}") from e
    if (pattern := options.get("format")) is not None:
        parsed_format(pattern)


def parsed_format(pattern: Any) -> tuple[str, list[str]]:
    """An anchored regular expression for a ``strptime`` pattern, and the directives of its groups."""
    if not isinstance(pattern, str) or not pattern:
        raise MappingError("format is a strptime pattern")
    for short, long in COMPOSED.items():
        pattern = re.sub(rf"(?<!%)((?:%%)*)%{short}", lambda m, long=long: m[1] + long, pattern)
    out, groups, i = "", [], 0
    while i < len(pattern):
        c = pattern[i]
        if c == "%":
            directive = pattern[i + 1 : i + 2]
            i += 2
            if directive == "%":
                out += "%"
            elif directive in DIRECTIVES:
                out += f"({DIRECTIVES[directive]})"
                groups.append(directive)
            else:
                raise MappingError(f"%{directive} counts weeks and is not read" if directive and directive in REFUSED else f"%{directive} is no directive")
        elif c.isspace():
            out, i = out + r"\s+", i + len(pattern[i:]) - len(pattern[i:].lstrip())
        else:
            out, i = out + (c if c.isalnum() or c == "_" or ord(c) > 127 else "\\" + c), i + 1
    if len(groups) != len(set(groups)):
        raise MappingError("a directive stands twice in the format")
    return f"(?i)^{out}$", groups


def _two(number: Column) -> Column:
    return F.lpad(F.trim(number), 2, "0")


def by_format(text: Column, pattern: str, zone: str | None) -> tuple[Column, Column]:
    """(date, timestamp) of a text written as ``pattern`` says; parts that it lacks are those of 1900-01-01 at midnight."""
    regex, groups = parsed_format(pattern)
    part = {g: F.regexp_extract(text, regex, i + 1) for i, g in enumerate(groups)}
    fits = text.rlike(regex)
    year = part.get("Y")
    if year is None:
        year = F.concat(F.when(part["y"].try_cast("int") < 69, "20").otherwise("19"), part["y"]) if "y" in part else F.lit("1900")
    named = part.get("b", part.get("B"))
    month = _two(part["m"]) if "m" in part else _two(F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.lower(F.substring(named, 1, 3))).cast("string")) if named is not None else F.lit("01")
    day = _two(part["d"]) if "d" in part else F.lit("01")
    date = F.concat_ws("-", year, month, day)
    if "j" in part and not {"m", "b", "B", "d"} & set(part):
        at = F.date_add(F.concat(year, F.lit("-01-01")).try_cast("date"), part["j"].try_cast("int") - 1)
        date = F.when(F.year(at) == year.try_cast("int"), at.cast("string"))
    hour = part.get("H")
    if hour is None:
        half = part.get("p")
        twelve = part["I"].try_cast("int") % 12 if "I" in part else F.lit(0)
        hour = (twelve + F.when(F.lower(half) == "pm", 12).otherwise(0) if half is not None and "I" in part else twelve).cast("string")
    time = F.concat(_two(hour), F.lit(":"), _two(part.get("M", F.lit("0"))), F.lit(":"), _two(part.get("S", F.lit("0"))), F.lit("."), F.rpad(part.get("f", F.lit("0")), 6, "0"))
    offset = F.upper(part["z"]) if "z" in part else F.lit("Z") if "Z" in part or zone is None else F.lit(" " + zone)
    offset = F.regexp_replace(offset, r"^([+-][0-9]{2})([0-9]{2})$", "$1:$2")
    return F.when(fits, date).try_cast("date"), F.when(fits & date.try_cast("date").isNotNull(), F.concat(date, F.lit("T"), time, offset)).try_cast("timestamp")


def iso_timestamp(text: Column, zone: str | None) -> Column:
    """A timestamp from an ISO text; one without an offset is on the clock of ``zone``, or in UTC, whatever the session's zone."""
    full = F.replace(F.when(text.rlike(rf"^{_ISO_DATE}$"), F.concat(text, F.lit("T00:00:00"))).otherwise(text), F.lit(","), F.lit("."))
    full = F.regexp_replace(full, r"^(.{10}[T ][0-9]{2}:[0-9]{2})(?!:)", "$1:00")
    zoned = full.rlike(rf"T?.*[0-9]{_OFFSET}$") & F.substring(full, 11, 100).rlike(_OFFSET)
    full = F.when(zoned, F.regexp_replace(full, r"([+-][0-9]{2})([0-9]{2})$", "$1:$2")).otherwise(F.concat(full, F.lit("Z" if zone is None else " " + zone)))
    return F.when(text.rlike(_ISO), full).try_cast("timestamp")


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often it stands there."""
    return F.get(F.transform(F.array(value), then), 0)


def _double_text(value: Column) -> Column:
    """A double as Python writes it: the fewest digits that read back the same, no exponent from 1e-4 up to 1e16."""

    def shortest(v: Column) -> Column:
        short = [F.format_string(f"%.{n}e", v) for n in (14, 15)]
        return _bound(short[0], lambda t: F.when(t.try_cast("double") == v, t).otherwise(_bound(short[1], lambda u: F.when(u.try_cast("double") == v, u).otherwise(F.format_string("%.16e", v)))))

    def parts(text: Column) -> Column:
        bare = F.regexp_replace(text, "^-", "")
        digits = F.regexp_replace(F.translate(F.substring_index(bare, "e", 1), ".", ""), "(?<=.)0+$", "")
        return F.struct(F.when(text.startswith("-"), "-").otherwise("").alias("sign"), F.substring_index(bare, "e", -1).try_cast("int").alias("power"), digits.alias("digits"), F.length(digits).alias("n"))

    def written(x: Column) -> Column:
        power, digits, n = x["power"], x["digits"], x["n"]
        cut = lambda at: F.concat(F.call_function("substring", digits, F.lit(1), at), F.lit("."), F.call_function("substring", digits, at + 1))
        plain = F.when(power < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)).when(n <= power + 1, F.concat(F.rpad(digits, 17, "0").substr(F.lit(1), power + 1), F.lit(".0"))).otherwise(cut(power + 1))
        size = F.abs(power).cast("string")
        far = F.concat(F.when(n == 1, digits).otherwise(cut(F.lit(1))), F.when(power < 0, "e-").otherwise("e+"), F.when(F.length(size) < 2, F.concat(F.lit("0"), size)).otherwise(size))
        return F.concat(x["sign"], F.when(power.between(-4, 15), plain).otherwise(far))

    infinite = F.when(value > 0, "inf").otherwise("-inf")
    number = _bound(value, lambda v: _bound(shortest(v), lambda t: _bound(parts(t), written)))
    return F.when(F.isnan(value), "nan").when(F.abs(value) == float("inf"), infinite).otherwise(number)


def _clock(text: Column) -> Column:
    """Fractions of a second in six digits."""
    return F.when(F.contains(text, F.lit(".")), F.concat(F.substring_index(text, ".", 1), F.lit("."), F.rpad(F.substring_index(text, ".", -1), 6, "0"))).otherwise(text)


def utc(value: Column) -> Column:
    """A timestamp's clock in UTC, as a timestamp without a zone, whatever the session's zone."""
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.unix_micros(value).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)"))


def as_text(value: Column, kind: T.DataType) -> Column:
    """A value as the mapping language writes it."""
    if isinstance(kind, T.BooleanType):
        return F.when(value, "True").when(~value, "False")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return _double_text(value.cast("string").cast("double") if isinstance(kind, T.FloatType) else value)
    if isinstance(kind, T.TimestampType):
        return F.concat(_clock(utc(value).cast("string")), F.lit("+00:00"))
    if isinstance(kind, T.TimestampNTZType):
        return _clock(value.cast("string"))
    return F.to_json(value) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else value.cast("string")


def is_json(text: Column) -> Column:
    """Whether a text is one JSON value and nothing else; Spark's parser alone stops behind the first value.

    As the one element of an array it can't go on with a comma or a brace, as a field's value not with a bracket.
    """
    one = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    return F.coalesce((F.size(one) == 1) & F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull(), F.lit(False))


def _fits(number: Column) -> Column:
    """Whether a number's text has no digit but zeros behind its 18th decimal."""
    low = F.lower(number)
    mantissa, power = F.substring_index(low, "e", 1), F.when(F.contains(low, F.lit("e")), F.substring_index(low, "e", -1).try_cast("int")).otherwise(0)
    digits = F.regexp_replace(mantissa, r"(\.[0-9]*?)0+$", "$1")
    behind = F.length(F.regexp_extract(digits, r"\.([0-9]*)$", 1))
    before = F.length(F.regexp_extract(mantissa, r"^[^.]*?(0*)\.?0*$", 1))
    return (F.when(behind > 0, behind).otherwise(-before) - power <= 18) | ~mantissa.rlike("[1-9]")


def _kept(value: Column, kind: T.DecimalType) -> Column:
    """A decimal with 18 decimals, null where one behind them would go."""
    out = value.try_cast("decimal(38,18)")
    return out if kind.scale <= 18 else F.when(out.try_cast(kind) == value, out)


def value_of(value: Column, kind: T.DataType, name: str, strip: str = "", decimal_separator: str = ".", format: str | None = None, timezone: str | None = None, max_length: int | None = None) -> tuple[Column, T.DataType]:  # noqa: A002
    """(value, type) of a cast; null where it fails."""
    is_text, whole = isinstance(kind, T.StringType), isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    near, exact = isinstance(kind, (T.DoubleType, T.FloatType)), isinstance(kind, T.DecimalType)
    flag, nothing = isinstance(kind, T.BooleanType), F.lit(None)
    text = value.cast("string") if not isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else F.to_json(value)
    number = F.trim(text)
    if is_text and strip:
        number = F.trim(F.translate(number, strip, ""))
    if is_text and decimal_separator != ".":
        number = F.replace(number, F.lit(decimal_separator), F.lit("."))
    if name == "string":
        out = as_text(value, kind)
        return (out if max_length is None else F.when(F.length(out) <= max_length, out)), T.StringType()
    if name == "integer":
        if near or exact:
            return F.when(value == F.floor(value), value.try_cast("bigint")), T.LongType()
        return (F.when(number.rlike(r"^[+-]?[0-9]+$"), number.try_cast("bigint")) if is_text else value.try_cast("bigint") if whole or flag else nothing), T.LongType()
    if name == "decimal":
        if exact:
            return _kept(value, kind), T.DecimalType(38, 18)
        out = F.when(number.rlike(NUMBER) & _fits(number), number.try_cast("decimal(38,18)")) if is_text else F.when(_fits(text), text.try_cast("decimal(38,18)")) if near else value.try_cast("decimal(38,18)") if whole else nothing
        return out, T.DecimalType(38, 18)
    if name == "float":
        return (F.when(number.rlike(NUMBER), number.try_cast("double")) if is_text else value.try_cast("double") if whole or near or exact or flag else nothing), T.DoubleType()
    if name == "boolean":
        low = F.lower(F.trim(text))
        return (F.when(low.isin(*TRUE), True).when(low.isin(*FALSE), False) if is_text else value.cast("boolean") if whole or near or exact or flag else nothing), T.BooleanType()
    if name == "datetime":
        if is_text:
            return (by_format(F.trim(text), format, timezone)[1] if format else iso_timestamp(F.trim(text), timezone)), T.TimestampType()
        if isinstance(kind, (T.DateType, T.TimestampNTZType)):
            return F.concat(value.cast("timestamp_ntz").cast("string"), F.lit("Z")).try_cast("timestamp"), T.TimestampType()
        return (value if isinstance(kind, T.TimestampType) else F.timestamp_micros(F.round(value.cast("decimal(38,9)") * 1_000_000).try_cast("bigint")) if whole or near or exact else nothing), T.TimestampType()
    if name == "date":
        if is_text:
            return (by_format(F.trim(text), format, None)[0] if format else F.when(F.trim(text).rlike(rf"^{_ISO_DATE}$"), F.trim(text).try_cast("date"))), T.DateType()
        return (utc(value).cast("date") if isinstance(kind, T.TimestampType) else value.cast("date") if isinstance(kind, (T.DateType, T.TimestampNTZType)) else nothing), T.DateType()
    if is_text:
        return F.when(is_json(text), text), T.StringType()
    return (text if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else nothing), T.StringType()
