"""From raw entity tables to rows of the samples table, and on to published sets."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplyard.functions.columns import col, cols, data_type, hashable
from samplyard.functions.jsontext import serialise
from samplyard.functions.names import set_name
from samplyard.operators import clean, lookup, tables, update
from samplyard.operators.joins import complete, distinct_keys, keyed_join
from samplyard.schema import SchemaSpec
from samplyard.sources import store


def process_samples(
    df: DataFrame,
    schema: SchemaSpec,
    known: DataFrame | None = None,
    config: Mapping[str, Any] | None = None,
    configs: DataFrame | None = None,
    config_column: str | None = None,
    entity_type: str | None = None,
    unique_by_config: bool = False,
    dedupe_within_batch: bool = False,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    as_of=None,
) -> DataFrame:
    """The cleaning pipeline as one lazy plan.

    ``known`` is the samples table; its identifiers are never brought to the driver. Inherited
    values come from one ``config``, or per row from ``configs`` by ``config_column``.
    """
    if transform is not None:
        df = df.transform(transform)
    entity_type = entity_type or (config or {}).get("entity_type")
    if configs is not None:
        df = clean.attach_config(df, configs, config_column, list(schema.inherited.values()))
    shaped = clean.shape_columns(df, schema, entity_type, config)
    checked = (
        shaped.filter(clean.has_sequence_file(schema))
        .filter(clean.matches_patterns(schema, shaped.columns))
        .filter(clean.has_valid_dates(schema, shaped.columns, list(clean.system_value_columns(schema, as_of))))
    )
    identifier = schema.identifier
    if known is not None and identifier:
        checked = clean.drop_known(checked, known, identifier, schema.config_key if unique_by_config else None)
    if dedupe_within_batch and identifier:
        checked = clean.drop_repeats(checked, identifier, cols(hashable(checked)))
    return clean.finish_values(checked, schema, as_of)


def screen_samples(
    df: DataFrame,
    schema: SchemaSpec,
    known: DataFrame,
    configs: DataFrame,
    config_column: str,
    entity_type: str | None = None,
    unique_by_config: bool = False,
) -> DataFrame:
    """Shaped rows of all configs with a ``reason``: null for rows to load, else why not.

    One pass serves both the load and the per-config counts.
    """
    joined = clean.attach_config(df, configs, config_column, list(schema.inherited.values()))
    shaped = clean.shape_columns(joined, schema, entity_type, keep=[config_column])
    keys = [schema.identifier] + ([schema.config_key] if unique_by_config else [])
    seen = distinct_keys(known, keys).withColumn("__known", F.lit(True))
    marked = keyed_join(shaped, seen, keys)
    reason = F.when(col("__known"), "known").otherwise(clean.rejection(schema, shaped.columns))
    return marked.select(*cols(shaped.columns), reason.alias("reason"))


def prepare_configs(df: DataFrame, schema: SchemaSpec, as_of=None) -> DataFrame:
    """Configs ready to insert: ids and creation time where absent, nested values as JSON text."""
    out: list[Column] = []
    names = df.columns + [n for n in [*schema.primary_keys, "created_at"] if n in schema.names and n not in df.columns]
    for name in dict.fromkeys(names):
        spec = schema.by_name.get(name)
        value = col(name) if name in df.columns else F.lit(None).cast(spec.data_type)
        given = data_type(df, name) if name in df.columns else spec.data_type
        if spec is not None and spec.kind == "json":
            value = serialise(value, given)
        if name in schema.primary_keys:
            value = F.coalesce(value.cast("string"), F.expr("uuid()"))
        elif name == "created_at" and spec is not None and spec.attributes:
            value = F.coalesce(value.cast("timestamp_ntz"), clean.moment(as_of))
        out.append(value.alias(name))
    return df.select(*out)


def process_configs(df: DataFrame, schema: SchemaSpec, as_of=None) -> DataFrame:
    return clean.coerce_types(prepare_configs(df, schema, as_of), schema)


def load_configs(df: DataFrame, schema: SchemaSpec, path: str, as_of=None, mode: str = "append") -> dict[str, int]:
    """Append configs to the stored table; rows that lack a required field are refused and counted."""
    def cleaned(raw: DataFrame) -> DataFrame:
        done = process_configs(raw, schema, as_of)
        return complete(done, [n for n in schema.required if n in done.columns])

    return store.load_samples(df, cleaned, path, mode)


def waiting_for_upload(samples: DataFrame, timeframe: str = "today", as_of=None, **window) -> DataFrame:
    """Samples of the timeframe that are neither uploaded nor submitted."""
    return lookup.samples_in(samples, timeframe, as_of, newest_first=False, **window)


def upload_sets(waiting: DataFrame, configs: DataFrame, prefix: str, as_of=None, zone: str = "UTC", config_key: str = "config_id") -> DataFrame:
    """The waiting samples with the name of the set they are published in, one set per config."""
    names = configs.select(
        col("id").alias(config_key), set_name(col(prefix), clean.moment(as_of), zone).alias("set_name")
    )
    return keyed_join(waiting, names, config_key, "inner")


def mark_sets_uploaded(samples: DataFrame, published: DataFrame, as_of=None) -> DataFrame:
    """Stamp published samples with time and set; ``published`` has id and set_name."""
    values = {"uploaded_at": clean.moment(as_of), "upload_source": "$set_name"}
    return update.set_fields(samples, published.select("id", "set_name"), values, as_of)


def ingest_results(screened: DataFrame, waiting: DataFrame, configs: DataFrame, prefix: str, as_of=None, zone: str = "UTC", config_key: str = "config_id") -> DataFrame:
    """One result row per config: what was loaded, filtered and published, and the status.

    ``waiting`` are samples already in the table that are due for upload; freshly loaded rows
    are due as well. ``no_data`` means the config's table was empty.
    """
    loaded = screened.groupBy(col(config_key)).agg(
        F.count_if(col("reason").isNull()).alias("loaded"),
        F.count_if(col("reason").isNotNull()).alias("filtered"),
    )
    due = waiting.groupBy(col(config_key)).agg(F.count(F.lit(1)).alias("due"))
    base = configs.select(
        col("id").alias(config_key), set_name(col(prefix), clean.moment(as_of), zone).alias("__set")
    )
    joined = keyed_join(keyed_join(base, loaded, config_key), due, config_key)
    has_data = col("loaded").isNotNull()
    uploaded = F.when(has_data, F.coalesce(col("loaded"), F.lit(0)) + F.coalesce(col("due"), F.lit(0))).otherwise(0)
    status = F.when(~has_data, "no_data").when(uploaded == 0, "no_new_samples").otherwise("success")
    return joined.select(
        col(config_key),
        status.alias("status"),
        F.coalesce(col("loaded"), F.lit(0)).alias("loaded_count"),
        F.coalesce(col("filtered"), F.lit(0)).alias("filtered_count"),
        uploaded.cast("bigint").alias("uploaded_count"),
        F.when(status == "success", col("__set")).alias("set_name"),
    )


def ingest_all(
    raw: DataFrame,
    configs: DataFrame,
    samples: DataFrame,
    schema: SchemaSpec,
    config_column: str,
    prefix: str,
    entity_type: str | None = None,
    unique_by_config: bool = False,
    timeframe: str = "today",
    as_of=None,
    zone: str = "UTC",
) -> dict[str, DataFrame]:
    """Ingest the landed tables of all given configs as one job keyed by config.

    ``rows`` are to be appended to the samples table, ``results`` is one row per config. Publish
    from the stored table afterwards (:func:`waiting_for_upload`, :func:`upload_sets`): generated
    ids exist only once they are written.
    """
    key = schema.config_key
    ours = keyed_join(
        raw, configs.select(col("id").cast("string").alias(config_column)), config_column, "left_semi"
    )
    screened = screen_samples(ours, schema, samples, configs, config_column, entity_type, unique_by_config)
    if config_column != key:
        screened = screened.withColumn(key, F.coalesce(col(key), col(config_column)))
    accepted = screened.filter(col("reason").isNull()).select(*cols(schema.names))
    waiting = waiting_for_upload(samples, timeframe, as_of)
    results = ingest_results(screened, waiting, configs, prefix, as_of, zone, key)
    return {"rows": clean.finish_values(accepted, schema, as_of), "results": results}


def single_table_flow(
    samples: DataFrame,
    submissions: DataFrame,
    identifier: str,
    timeframe: str = "today",
    as_of=None,
    config_key: str = "config_id",
    **window,
) -> dict[str, DataFrame]:
    """Source and destination are one table: group by upload source, then mark as submitted.

    ``submissions`` gives the submission id of each (config, set).
    """
    ready = lookup.samples_in(
        samples, timeframe, as_of, "uploaded", "not_submitted", newest_first=False, **window
    )
    members = tables.sets_by_source(ready, identifier, config_key)
    named = keyed_join(
        ready.select("id", col(config_key), col("upload_source").alias("set_name")),
        submissions.select(col(config_key), "set_name", "submission_id"),
        [config_key, "set_name"],
        "inner",
    )
    return {
        "members": members,
        "sets": tables.set_sizes(members, config_key),
        "samples": update.mark_submitted(samples, named, as_of),
    }


def run_counts(results: DataFrame) -> DataFrame:
    """Configs per status and the totals they loaded and published."""
    return results.groupBy("status").agg(
        F.count(F.lit(1)).alias("configs"),
        F.sum("loaded_count").alias("loaded_count"),
        F.sum("uploaded_count").alias("uploaded_count"),
    )

