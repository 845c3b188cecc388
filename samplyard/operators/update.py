"""Keyed updates as one join.

A change record carries an id, its position in the call and a map of field -> new text. A field
that is not in the map is left alone, a field mapped to null is cleared: absent and null differ.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplyard.functions.columns import col, cols
from samplyard.functions.types import coerce
from samplyard.operators.clean import moment
from samplyard.operators.joins import complete, distinct_keys, first_per_key, keyed_join, without_keys
from samplyard.schema import SchemaSpec

CHANGES = "changes"
POSITION = "position"


def change_map(values: Mapping[str, Column]) -> Column:
    """Map column of the given fields; every field is present, nulls included."""
    pairs: list[Column] = []
    for name, value in values.items():
        pairs += [F.lit(name), value.cast("string")]
    return F.create_map(*pairs)


def present_only(changes: Column) -> Column:
    """The map without its null values."""
    return F.map_filter(changes, lambda _, value: value.isNotNull())


def change_records(df: DataFrame, values: Mapping[str, Column], key: str = "id", position: Column | None = None) -> DataFrame:
    """Change records from a table with one record per row."""
    return df.select(
        col(key),
        (F.lit(0) if position is None else position).cast("bigint").alias(POSITION),
        change_map(values).alias(CHANGES),
    )


def _carried(name: str, allow_nulls: bool) -> Column:
    if allow_nulls:
        return F.coalesce(F.map_contains_key(col(CHANGES), F.lit(name)), F.lit(False))
    return F.element_at(col(CHANGES), F.lit(name)).isNotNull()


def _any_carried(fields: Sequence[str], allow_nulls: bool) -> Column:
    return reduce(or_, [_carried(n, allow_nulls) for n in fields], F.lit(False))


def _unknown(schema: SchemaSpec, allow_nulls: bool) -> Column:
    """Names in the record that the schema lacks; a dropped null does not count."""
    kept = col(CHANGES) if allow_nulls else present_only(col(CHANGES))
    return F.array_except(F.map_keys(kept), F.array(*[F.lit(n) for n in schema.names]))


def _place(batch_size: int) -> Column:
    """Smaller is stronger: the last batch first, inside a batch the first record."""
    place, size = col(POSITION), F.lit(batch_size).cast("bigint")
    return F.pmod(place, size) - F.floor(place / size) * size


def _is_odd(schema: SchemaSpec, allow_nulls: bool) -> Column:
    """Whether a record names an unknown field; only one that does pays for the look at its values."""
    names = F.array(*[F.lit(n) for n in schema.names])
    odd = F.size(F.array_except(F.map_keys(col(CHANGES)), names)) > 0
    return F.coalesce(F.when(odd, F.size(_unknown(schema, allow_nulls)) > 0), F.lit(False))


def check_records(updates: DataFrame, schema: SchemaSpec, allow_nulls: bool = False) -> DataFrame:
    """The records; the job fails on one that names a field the schema lacks."""
    message = F.concat(F.lit("fields not in schema: "), F.concat_ws(", ", _unknown(schema, allow_nulls)))
    failed = F.when(_is_odd(schema, allow_nulls), F.raise_error(message).cast("boolean"))
    return updates.filter(failed.isNull())


def settle_records(
    updates: DataFrame, fields: Sequence[str], key: str = "id", batch_size: int = 1000, allow_nulls: bool = False
) -> DataFrame:
    """One row per id with a ``struct(value)`` per field, null where nothing is to be written.

    When records repeat an id, each field takes the first record that carries it inside a batch,
    and the last batch that carries it. Both rules are one ordering, so this is a plain
    aggregate that combines on the map side. Records without an id or without any field left
    drop out. The map is taken apart first: only flat values are sorted and shuffled.
    """
    usable = updates.filter(col(key).isNotNull() & _any_carried(fields, allow_nulls))
    flat = usable.select(
        col(key),
        *[F.element_at(col(CHANGES), F.lit(n)).alias(f"value_{n}") for n in fields],
        *[F.when(_carried(n, allow_nulls), _place(batch_size)).alias(f"place_{n}") for n in fields],
    )
    picks = [
        F.min_by(F.struct(col(f"value_{n}").alias("value")), col(f"place_{n}")).alias(f"new_{n}")
        for n in fields
    ]
    return flat.groupBy(col(key)).agg(*picks)


def apply_records(
    target: DataFrame,
    updates: DataFrame,
    schema: SchemaSpec,
    as_of=None,
    key: str = "id",
    fields: Sequence[str] | None = None,
    allow_nulls: bool = False,
    batch_size: int = 1000,
    stamp: str = "updated_at",
) -> DataFrame:
    """The target with all changes applied; every matched row gets ``updated_at``.

    ``fields`` lists what the records may touch (default: every declared field but the id).
    """
    fields = [n for n in (fields or schema.names) if n != key and n in target.columns]
    schema.check_fields(fields)
    checked = check_records(updates, schema, allow_nulls)
    settled = settle_records(checked, fields, key, batch_size, allow_nulls)
    joined = keyed_join(target, settled.withColumn("__hit", F.lit(True)), key)
    return joined.select(*_written(target, schema, fields, stamp, as_of))


def apply_settled(
    target: DataFrame, settled: DataFrame, schema: SchemaSpec, as_of=None, key: str = "id", stamp: str = "updated_at"
) -> DataFrame:
    """The target with settled rows written: one per id, a ``struct(value)`` named ``new_<field>`` each."""
    fields = [n for n in target.columns if n != key and f"new_{n}" in settled.columns]
    schema.check_fields(fields)
    side = settled.select(col(key), *[col(f"new_{n}") for n in fields], F.lit(True).alias("__hit"))
    joined = keyed_join(target, side, key, unique=True)
    return joined.select(*_written(target, schema, fields, stamp, as_of))


def _written(target: DataFrame, schema: SchemaSpec, fields: Sequence[str], stamp: str, as_of) -> list[Column]:
    out = []
    for name in target.columns:
        if name == stamp:
            out.append(F.when(col("__hit"), moment(as_of)).otherwise(col(name)).alias(name))
        elif name in fields:
            new = col(f"new_{name}")
            typed = coerce(new["value"], schema.by_name[name].kind)
            out.append(F.when(new.isNotNull(), typed).otherwise(col(name)).alias(name))
        else:
            out.append(col(name))
    return out


def set_fields(
    target: DataFrame,
    ids: DataFrame,
    values: Mapping[str, Any],
    as_of=None,
    key: str = "id",
    stamp: str = "updated_at",
) -> DataFrame:
    """Write values into the rows whose id is listed.

    A value is a literal, or the name of a column that ``ids`` brings along; of several rows of an
    id, the one with the least values counts.
    """
    brought = [v.removeprefix("$") for v in values.values() if isinstance(v, str) and v.startswith("$")]
    if brought:
        names = [f"__new_{n}" for n in dict.fromkeys(brought)]
        side = ids.select(col(key), *[col(n.removeprefix("__new_")).alias(n) for n in names])
        side = first_per_key(complete(side, [key]), [key], cols(names))
    else:
        side = distinct_keys(ids, [key])
    joined = keyed_join(target, side.withColumn("__hit", F.lit(True)), key)
    out = []
    for name in target.columns:
        if name in values:
            value = values[name]
            if isinstance(value, str) and value.startswith("$"):
                value = col(f"__new_{value.removeprefix('$')}")
            value = value if isinstance(value, Column) else F.lit(value)
            kind = target.schema[name].dataType
            out.append(F.when(col("__hit"), value.cast(kind)).otherwise(col(name)).alias(name))
        elif name == stamp:
            out.append(F.when(col("__hit"), moment(as_of)).otherwise(col(name)).alias(name))
        else:
            out.append(col(name))
    return joined.select(*out)


def mark_uploaded(samples: DataFrame, ids: DataFrame, upload_source: str, as_of=None) -> DataFrame:
    return set_fields(samples, ids, {"uploaded_at": moment(as_of), "upload_source": upload_source}, as_of)


def mark_submitted(
    samples: DataFrame, ids: DataFrame, as_of=None, submission: str = "submission_id", state: str = "workflow_state"
) -> DataFrame:
    """``ids`` brings the submission id of every sample."""
    values = {"submitted_at": moment(as_of), submission: "$" + submission, state: "Submitted"}
    return set_fields(samples, ids, values, as_of)


def update_where(
    target: DataFrame,
    condition: Column,
    values: Mapping[str, Any],
    schema: SchemaSpec | None = None,
    as_of=None,
    protected: Sequence[str] = ("id", "created_at"),
    stamps: Sequence[str] = ("updated_at",),
) -> DataFrame:
    """Write values where the condition holds, without any join.

    Protected fields are ignored, unknown ones refused, and the stamp fields get the time.
    """
    if schema is not None:
        schema.check_fields(values)
    hit = F.coalesce(condition, F.lit(False))
    out = {}
    for name, value in values.items():
        if name in protected:
            continue
        value = value if isinstance(value, Column) else F.lit(value)
        out[name] = F.when(hit, value.cast(target.schema[name].dataType)).otherwise(col(name))
    for name in stamps:
        if name in target.columns:
            out[name] = F.when(hit, moment(as_of)).otherwise(col(name))
    return target.withColumns(out)


def update_config(configs: DataFrame, config_id: str, values: Mapping[str, Any], schema: SchemaSpec | None = None, as_of=None) -> DataFrame:
    texts = {k: json.dumps(v) if isinstance(v, (dict, list)) else v for k, v in values.items()}
    stamps = ["updated_at"] + (schema.having("updated_datetime") if schema else [])
    return update_where(configs, col("id") == config_id, texts, schema, as_of, stamps=stamps)


def mark_transferred(configs: DataFrame, ids: DataFrame, as_of=None) -> DataFrame:
    return set_fields(configs, ids, {"transferred": True}, as_of)


def deactivate(configs: DataFrame, filters: Mapping[str, Any], as_of=None) -> DataFrame:
    """Switch off active configs that equal every filter value."""
    condition = col("active")
    for name, value in filters.items():
        condition = condition & (col(name) == F.lit(value))
    return update_where(configs, condition, {"active": False}, as_of=as_of)


def delete_ids(target: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return without_keys(target, ids, [key])


def accounting(
    target: DataFrame,
    updates: DataFrame,
    schema: SchemaSpec,
    key: str = "id",
    allow_nulls: bool = False,
    batch_size: int = 1000,
) -> DataFrame:
    """Records applied, unmatched and rejected per update batch."""
    fields = [n for n in schema.names if n != key]
    bad = col(key).isNull() | ~_any_carried(fields, allow_nulls) | _is_odd(schema, allow_nulls)
    marked = updates.select(
        col(key), F.floor(col(POSITION) / F.lit(batch_size)).cast("bigint").alias("batch"), bad.alias("rejected")
    )
    hits = keyed_join(marked, distinct_keys(target, [key]).withColumn("__hit", F.lit(True)), key)
    return hits.groupBy("batch").agg(
        F.count_if(~col("rejected") & col("__hit").isNotNull()).alias("applied"),
        F.count_if(~col("rejected") & col("__hit").isNull()).alias("unmatched"),
        F.count_if(col("rejected")).alias("rejected"),
    )
