"""JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def serialise(value: Column, given: T.DataType) -> Column:
    """Nested values as JSON text; text stays as it is."""
    if isinstance(given, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast("string")


def target_entity(method_config: Column) -> Column:
    """Entity type a method runs on, without its ``_set`` suffix."""
    return F.regexp_replace(F.get_json_object(method_config, "$.entityType"), "_set$", "")
