"""Comparing, merging, promoting and publishing entity tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplyard.functions.columns import col, cols, filled
from samplyard.functions.names import entity_id_column
from samplyard.operators.joins import distinct_keys, keyed_join, without_keys


def _keys_as(df: DataFrame, column: str, name: str) -> DataFrame:
    return distinct_keys(df.select(col(column).cast("string").alias(name)), [name])


def common_ids(left: DataFrame, right: DataFrame, left_key: str, right_key: str, name: str = "id") -> DataFrame:
    """Distinct non-null ids present in both tables."""
    return keyed_join(_keys_as(left, left_key, name), _keys_as(right, right_key, name), name, "left_semi")


def new_ids(left: DataFrame, right: DataFrame, left_key: str, right_key: str, name: str = "id") -> DataFrame:
    """Distinct non-null ids of the first table that the second lacks, compared as text."""
    return keyed_join(_keys_as(left, left_key, name), _keys_as(right, right_key, name), name, "left_anti")


def promote(
    source: DataFrame,
    destination: DataFrame | None,
    source_key: str,
    destination_key: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Source rows whose id the destination lacks, transformed, keyed for the destination."""
    if source_key not in source.columns:
        raise ValueError(f"identifier column {source_key!r} not found; columns are {source.columns}")
    rows = source.filter(col(source_key).isNotNull())
    if destination is not None and destination_key in destination.columns:
        known = destination.select(col(destination_key).cast("string").alias("__id"))
        rows = without_keys(rows.withColumn("__id", col(source_key).cast("string")), known, ["__id"]).drop("__id")
    if transform is not None:
        rows = rows.transform(transform)
    return rows.withColumnRenamed(source_key, destination_key)


def merge_tables(
    primary: DataFrame,
    secondary: DataFrame,
    primary_key: str,
    secondary_key: str,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
) -> DataFrame:
    """Rows present in both tables, with the columns of both.

    An include list wins over an exclude list; the key always stays. Other columns that both
    tables have are told apart by ``_x`` and ``_y``.
    """
    def chosen(names: Sequence[str]) -> list[str]:
        if include:
            return [n for n in include if n in names and n != primary_key]
        return [n for n in names if n != primary_key and n not in (exclude or ())]

    left_names = chosen(primary.columns)
    other = secondary.withColumnRenamed(secondary_key, primary_key)
    right_names = chosen(other.columns)
    clash = set(left_names) & set(right_names)
    left = primary.filter(col(primary_key).isNotNull()).select(
        col(primary_key), *[col(n).alias(n + "_x" if n in clash else n) for n in left_names]
    )
    right = other.filter(col(primary_key).isNotNull()).select(
        col(primary_key), *[col(n).alias(n + "_y" if n in clash else n) for n in right_names]
    )
    return keyed_join(left, right, primary_key, "inner")


def merge_into_master(
    primary: DataFrame,
    secondary: DataFrame,
    master: DataFrame | None,
    primary_key: str,
    secondary_key: str,
    master_key: str,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
) -> DataFrame:
    """Merged rows the master table does not have yet, keyed for the master.

    The master is subtracted from the primary side first, so rows it already has are not joined.
    """
    fresh = primary
    if master is not None and master.columns and master_key in master.columns:
        known = master.select(col(master_key).alias(primary_key))
        fresh = without_keys(primary.filter(col(primary_key).isNotNull()), known, [primary_key])
    merged = merge_tables(fresh, secondary, primary_key, secondary_key, include, exclude)
    return merged.withColumnRenamed(primary_key, master_key)


def publish_layout(df: DataFrame, target: str, identifier: str | None = None) -> DataFrame:
    """Identifier first, named ``entity:<target>_id``; the first column stands in for a missing one."""
    first = identifier if identifier in df.columns else df.columns[0]
    rest = [n for n in df.columns if n != first]
    return df.select(col(first).alias(entity_id_column(target)), *cols(rest))


def set_membership(entities: DataFrame, entity_type: str, set_name: str | Column, key: str | None = None) -> DataFrame:
    """(set, entity) rows in the layout of a membership table."""
    name = set_name if isinstance(set_name, Column) else F.lit(set_name)
    return entities.select(
        name.alias(f"membership:{entity_type}_set_id"), col(key or entities.columns[0]).alias(entity_type)
    )


def sets_by_source(samples: DataFrame, identifier: str, config_key: str = "config_id") -> DataFrame:
    """Members of one set per (config, upload source), as rows."""
    return samples.filter(col("upload_source").isNotNull()).select(
        col(config_key), col("upload_source").alias("set_name"), col(identifier).alias("entity")
    )


def set_sizes(members: DataFrame, config_key: str = "config_id") -> DataFrame:
    return members.groupBy(config_key, "set_name").agg(F.count(F.lit(1)).alias("members"))


def entity_id_map(samples: DataFrame, identifier: str, key: str = "id") -> DataFrame:
    return samples.select(col(identifier), col(key))


def new_entity_types(tables: DataFrame, configs: DataFrame, pattern: str | None = None, name: str = "entity_type") -> DataFrame:
    """Tables that no config covers yet, optionally only those whose name contains the pattern."""
    found = tables.select(col(name)).distinct()
    if pattern:
        found = found.filter(col(name).rlike(pattern.replace("(?P<", "(?<")))
    return keyed_join(found, distinct_keys(configs.filter(filled(col(name))), [name]), name, "left_anti")


def configs_from_template(
    tables: DataFrame,
    template: Mapping[str, Any] | None = None,
    defaults: Mapping[str, Any] | None = None,
    computed: Mapping[str, Any] | None = None,
    overrides: Mapping[str, Any] | None = None,
    required: Sequence[str] = (),
    name: str = "entity_type",
) -> DataFrame:
    """One config per new table: template, then defaults for gaps, computed fields, overrides.

    The template is a set of literals, so no join is needed. Nested values become JSON text.
    """
    merged: dict[str, Any] = dict(template or {})
    for key, value in (defaults or {}).items():
        merged.setdefault(key, value)
    merged.update({"id": F.expr("uuid()"), name: col(name), "active": True, "transferred": False})
    merged.update(computed or {})
    merged.update(overrides or {})
    missing = [field for field in required if field not in merged]
    if missing:
        raise ValueError(f"missing required fields in config: {', '.join(missing)}")

    def literal(value: Any) -> Column:
        if isinstance(value, Column):
            return value
        return F.lit(json.dumps(value) if isinstance(value, (dict, list)) else value)

    return tables.select(*[literal(value).alias(key) for key, value in merged.items()])
