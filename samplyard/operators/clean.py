"""Cleaning steps that turn a raw entity table into rows of a declared table.

Which source feeds which field is decided from the column names, on the driver; the data then
goes through one projection, one filter, at most one join, and one projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samplyard.functions.columns import col, cols, data_type, filled, hashable
from samplyard.functions.dates import format_date, parse_wall, utc_wall
from samplyard.functions.types import coerce
from samplyard.operators.joins import complete, first_per_key, keyed_join, without_keys
from samplyard.schema import SchemaSpec

CONFIG_PREFIX = "__config_"


def moment(as_of: datetime | str | Column | None) -> Column:
    """UTC wall time as ``timestamp_ntz``; the current time when nothing is given."""
    if as_of is None:
        return utc_wall(F.current_timestamp())
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")


# ---- columns -------------------------------------------------------------------------------

def rename_entity_id(df: DataFrame, schema: SchemaSpec, entity_type: str | None) -> DataFrame:
    """``entity:<type>_id`` becomes the identifier, unless the schema names its own source."""
    if not entity_type:
        return df
    identifier = schema.identifier
    if identifier is None:
        raise ValueError("the schema marks no field as sample_identifier")
    column = f"entity:{entity_type}_id"
    if schema.identifier_sources or column not in df.columns:
        return df
    keep = [name for name in df.columns if name != identifier]
    return df.select(*[col(n).alias(identifier) if n == column else col(n) for n in keep])


def field_sources(columns: Sequence[str], schema: SchemaSpec) -> dict[str, str | None]:
    """Source column of every field: first mapped column present, else its own name, else none."""
    available = list(columns)
    return {
        name: schema.source_for(name, available) or (name if name in available else None)
        for name in schema.names
    }


def map_columns(df: DataFrame, schema: SchemaSpec) -> DataFrame:
    """Fill mapped fields; a source is dropped unless it is itself a field."""
    mapped = {n: schema.source_for(n, df.columns) for n in schema.names}
    mapped = {n: s for n, s in mapped.items() if s}
    used = set(mapped.values())
    keep = [n for n in df.columns if n not in mapped and (n not in used or n in schema.names)]
    return df.select(*cols(keep), *[col(s).alias(n) for n, s in mapped.items()])


def complete_columns(df: DataFrame, schema: SchemaSpec) -> DataFrame:
    """Add absent fields as typed nulls."""
    absent = [f for f in schema.fields if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.data_type).alias(f.name) for f in absent])


def prune_columns(df: DataFrame, schema: SchemaSpec) -> DataFrame:
    return df.select(*cols([n for n in df.columns if n in schema.names]))


def drop_system_columns(df: DataFrame, schema: SchemaSpec) -> DataFrame:
    system = set(schema.system_fields)
    return df.select(*cols([n for n in df.columns if n not in system]))


def attach_config(df: DataFrame, configs: DataFrame, key: str, wanted: Sequence[str], config_id: str = "id") -> DataFrame:
    """Add the wanted columns of each row's config under a reserved prefix."""
    present = [name for name in dict.fromkeys(wanted) if name in configs.columns]
    side = configs.select(
        col(config_id).alias(key), *[col(n).alias(CONFIG_PREFIX + n) for n in present]
    )
    # One config per id: of several, the one with the least values.
    plain = [n for n in side.columns if n != key and n in hashable(side)]
    return keyed_join(df, first_per_key(complete(side, [key]), [key], cols(plain) or [F.lit(0)]) if present else side.distinct(), key, "left")


def inherit_from_config(df: DataFrame, schema: SchemaSpec, config: Mapping[str, Any]) -> DataFrame:
    """Overwrite inheriting fields with the value of one config; absent config keys change nothing."""
    values = {f: config[k] for f, k in schema.inherited.items() if k in config}
    return df.withColumns({f: F.lit(v) for f, v in values.items()}) if values else df


def shape_columns(
    df: DataFrame,
    schema: SchemaSpec,
    entity_type: str | None = None,
    config: Mapping[str, Any] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rename, map, complete, inherit and prune in one projection.

    Inherited values come from ``config``, or per row from columns :func:`attach_config` added.
    ``keep`` names further columns to carry along.
    """
    df = rename_entity_id(df, schema, entity_type)
    sources = field_sources(df.columns, schema)
    out: list[Column] = []
    for spec in schema.fields:
        inherited = schema.inherited.get(spec.name)
        if config is not None and inherited in config:
            value = F.lit(config[inherited])
        elif inherited and CONFIG_PREFIX + inherited in df.columns:
            value = col(CONFIG_PREFIX + inherited)
        elif sources[spec.name]:
            value = col(sources[spec.name])
        else:
            value = F.lit(None).cast(spec.data_type)
        out.append(value.alias(spec.name))
    return df.select(*out, *cols([n for n in keep if n not in schema.names]))


# ---- row checks, each a Boolean column that is never null -----------------------------------

def has_sequence_file(schema: SchemaSpec) -> Column:
    """At least one sequence file named; always true when the schema declares none."""
    if not schema.sequence_files:
        return F.lit(True)
    present = F.lit(False)
    for name in schema.sequence_files:
        present = present | filled(col(name))
    return F.coalesce(present, F.lit(False))


def java_pattern(pattern: str) -> str:
    """Python regex text as a pattern that must match at the start."""
    return r"\A(?:" + pattern.replace("(?P<", "(?<") + ")"


def matches_patterns(schema: SchemaSpec, columns: Sequence[str]) -> Column:
    """Every patterned field is null or matches at its start."""
    ok = F.lit(True)
    for name, pattern in schema.patterns.items():
        if name in columns:
            text = col(name).cast("string")
            ok = ok & (text.isNull() | text.rlike(java_pattern(pattern)))
    return F.coalesce(ok, F.lit(False))


def has_valid_dates(schema: SchemaSpec, columns: Sequence[str], generated: Sequence[str] = ()) -> Column:
    """Every field with a date layout is null or can be read as a date.

    ``generated`` fields are overwritten before their dates are read, so their raw values don't count.
    """
    ok = F.lit(True)
    for name, layout in schema.date_formats.items():
        if name in columns and name not in generated:
            text = col(name).cast("string")
            ok = ok & (text.isNull() | parse_wall(text, layout).isNotNull())
    return F.coalesce(ok, F.lit(False))


def rejection(schema: SchemaSpec, columns: Sequence[str]) -> Column:
    """Why a row is refused, null for a good row; the checks that need no other table."""
    return (
        F.when(~has_sequence_file(schema), "no_sequence_file")
        .when(~matches_patterns(schema, columns), "pattern")
        .when(~has_valid_dates(schema, columns, list(system_value_columns(schema, None))), "date")
    )


def missing_required(df: DataFrame, schema: SchemaSpec) -> DataFrame:
    """How many rows lack each required field: (field, missing), in one pass."""
    counts = [
        F.count_if(col(n).isNull()).alias(n) if n in df.columns else F.count(F.lit(1)).alias(n)
        for n in schema.required
    ]
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), col(n).alias("missing")) for n in schema.required])
    return df.agg(*counts).select(F.inline(pairs))


# ---- known rows ----------------------------------------------------------------------------

def drop_known(batch: DataFrame, known: DataFrame, identifier: str, scope: str | None = None) -> DataFrame:
    """Rows whose identifier is not in ``known``, within the same ``scope`` value if one is named.

    Null identifiers are kept, and so are repeats inside the batch.
    """
    return without_keys(batch, known, [identifier] + ([scope] if scope else []))


def drop_repeats(batch: DataFrame, identifier: str, order: Sequence[Column]) -> DataFrame:
    """Keep the first row per identifier; rows without an identifier all stay."""
    named = first_per_key(batch.filter(col(identifier).isNotNull()), [identifier], order)
    return named.select(*cols(batch.columns)).unionByName(batch.filter(col(identifier).isNull()))


# ---- values --------------------------------------------------------------------------------

def system_value_columns(schema: SchemaSpec, as_of) -> dict[str, Column]:
    """Generated values that always overwrite: a fresh UUID per primary key, and ``created_at``."""
    values = {name: F.expr("uuid()") for name in schema.primary_keys}
    created = schema.by_name.get("created_at")
    if created is not None and created.attributes and "created_at" not in values:
        values["created_at"] = moment(as_of)
    return values


def add_system_values(df: DataFrame, schema: SchemaSpec, as_of=None) -> DataFrame:
    return df.withColumns(system_value_columns(schema, as_of))


def format_dates(df: DataFrame, schema: SchemaSpec) -> DataFrame:
    """Rewrite dated fields in their layout and drop rows that hold an unreadable date."""
    layouts = {n: f for n, f in schema.date_formats.items() if n in df.columns}
    rewritten = {n: format_date(col(n).cast("string"), f) for n, f in layouts.items()}
    valid = df.filter(has_valid_dates(schema, df.columns))
    return valid.withColumns(rewritten) if rewritten else valid


def coerce_types(df: DataFrame, schema: SchemaSpec) -> DataFrame:
    """Give every declared column its type; other columns stay."""
    out = []
    for name in df.columns:
        spec = schema.by_name.get(name)
        if spec is None:
            out.append(col(name))
        else:
            out.append(coerce(col(name), spec.kind, data_type(df, name), spec.data_type).alias(name, metadata=spec.struct_field.metadata))
    return df.select(*out)


def finish_values(df: DataFrame, schema: SchemaSpec, as_of=None) -> DataFrame:
    """System values, date layouts and types in one projection; row checks are done before."""
    generated = system_value_columns(schema, as_of)
    layouts = schema.date_formats
    out = []
    for name in df.columns:
        spec = schema.by_name.get(name)
        if spec is None:
            out.append(col(name))
            continue
        value, given = col(name), data_type(df, name)
        if name in generated:
            value = generated[name]
            given = T.StringType() if name in schema.primary_keys else T.TimestampNTZType()
        if name in layouts:
            value = format_date(value.cast("string"), layouts[name])
            given = None
        out.append(coerce(value, spec.kind, given, spec.data_type).alias(name, metadata=spec.struct_field.metadata))
    return df.select(*out)
