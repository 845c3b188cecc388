"""Column references for names such as ``entity:sample_id`` or ``a.b``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def cols(names) -> list[Column]:
    return [col(name) for name in names]


def is_blank(value: Column) -> Column:
    """Null or the empty string."""
    return value.isNull() | (value.cast("string") == "")


def filled(value: Column) -> Column:
    return ~is_blank(value)


def data_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def hashable(df: DataFrame) -> list[str]:
    """Columns that can feed a hash (maps cannot)."""
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
