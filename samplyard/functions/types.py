"""One rule set for turning raw values into the declared type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samplyard.functions.dates import parse_utc, parse_wall, utc_instant

# The only texts that count as booleans.
TRUE_TEXTS = ("true", "True", "TRUE", "1")
FALSE_TEXTS = ("false", "False", "FALSE", "0")

NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"
NUMBER_OR_INFINITE = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?)\s*$"


def to_float(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.rlike(NUMBER_OR_INFINITE), F.trim(text).try_cast("double"))


def to_integer(value: Column) -> Column:
    """Whole numbers, also written as ``3.0`` or ``1e3``; a fraction gives null.

    Shapes are tested before casting: a failing cast is slow.
    """
    text = F.trim(value.cast("string"))
    number = text.try_cast("double")
    whole = F.when(number % 1 == 0, number.try_cast("bigint"))
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint")).when(text.rlike(NUMBER), whole)


def to_boolean(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isin(*TRUE_TEXTS), True).when(text.isin(*FALSE_TEXTS), False)


def coerce(value: Column, kind: str, given: T.DataType | None = None, declared: T.DataType | None = None) -> Column:
    """``value`` as the declared kind; what does not fit becomes null.

    ``given`` is the column's present type; text is assumed. ``declared`` is the full type of a
    record or array, which text is then parsed into.
    """
    given = given or T.StringType()
    if kind in ("record", "array") and declared is not None and isinstance(given, T.StringType):
        return F.from_json(value, declared)
    if isinstance(given, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(value) if kind in ("string", "json") else value
    temporal = isinstance(given, (T.TimestampType, T.TimestampNTZType, T.DateType))
    if kind == "integer":
        return value.cast("bigint") if isinstance(given, T.IntegralType) else to_integer(value)
    if kind == "float":
        return value.cast("double") if isinstance(given, T.NumericType) else to_float(value)
    if kind == "boolean":
        return value if isinstance(given, T.BooleanType) else to_boolean(value)
    if kind == "date":
        return (value if temporal else parse_wall(value.cast("string"))).cast("date")
    if kind == "datetime":
        return value.cast("timestamp_ntz") if temporal else parse_utc(value.cast("string"))
    if kind == "timestamp":
        if isinstance(given, T.TimestampType):
            return value
        naive = value.cast("timestamp_ntz") if temporal else parse_utc(value.cast("string"))
        return utc_instant(naive)
    if kind in ("string", "json"):
        return value.cast("string")
    return value
