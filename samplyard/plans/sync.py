"""Metadata sync of all configs in one job."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplyard.functions.columns import col, cols
from samplyard.operators import lookup, update
from samplyard.operators.clean import moment
from samplyard.operators.joins import complete, distinct_keys, first_per_key, keyed_join
from samplyard.operators.summary import derived_status
from samplyard.operators.sync import changed_fields, sample_changes, unfolded
from samplyard.schema import SchemaSpec
from samplyard.session import checkpoint_root


def changes_for_configs(
    samples: DataFrame,
    source: DataFrame,
    configs: DataFrame,
    schema: SchemaSpec,
    source_key: str,
    fields: Sequence[str] | None = None,
    days_back: int = 30,
    as_of=None,
    overwrite: bool = False,
    allow_null: bool = False,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """What to write into the samples of the given configs inside the look-back: one row per sample.

    Source rows carry the config column, so one config never reads another one's table.
    """
    key = schema.config_key
    recent = lookup.in_timeframe(samples, "custom", as_of, days_back=days_back)
    ours = keyed_join(recent, configs.select(col("id").cast("string").alias(key)), key, "left_semi")
    return sample_changes(
        ours,
        source,
        schema,
        fields or schema.sync_fields,
        schema.identifier,
        overwrite,
        allow_null,
        source_key=source_key,
        tie_break=tie_break,
        scope=[key],
    )


def apply_to_samples(samples: DataFrame, changes: DataFrame, schema: SchemaSpec, as_of=None) -> DataFrame:
    """Samples with the changes written; of several rows of an id, the first by identifier counts."""
    settled = first_per_key(complete(changes, ["id"]), ["id"], [col(schema.identifier)])
    return update.apply_settled(samples, settled, schema, as_of)


def _passed_on(fields: Sequence[str]) -> Column:
    """Whether a sample has a value that goes on to the destination."""
    flags = [F.coalesce(col(f"new_{n}")["propagate"], F.lit(False)) for n in fields]
    return reduce(or_, flags, F.lit(False))


def apply_to_destination(destination: DataFrame, changes: DataFrame, schema: SchemaSpec, key: str, scope: Sequence[str] = ()) -> DataFrame:
    """Destination entities with the propagated values written.

    Several samples may stand for one entity; the sample with the greatest id is written last.
    """
    fields = [n for n in changed_fields(changes) if n in destination.columns]
    picks = [
        F.max_by(F.struct(col(f"new_{n}")["value"].alias("value")), F.when(col(f"new_{n}")["propagate"], col("id"))).alias(f"new_{n}")
        for n in fields
    ]
    passed = changes.filter(_passed_on(fields)).withColumnRenamed(schema.identifier, key)
    settled = passed.groupBy(*cols(scope), col(key)).agg(*picks)
    joined = keyed_join(destination, settled, [*scope, key])
    return joined.select(
        *[
            F.coalesce(col(f"new_{n}")["value"], col(n)).alias(n) if n in fields else col(n)
            for n in destination.columns
        ]
    )


def sync_results(changes: DataFrame, destination: DataFrame, configs: DataFrame, schema: SchemaSpec, key: str) -> DataFrame:
    """Per config: samples updated, entities patched, entities that were not found, status."""
    config = schema.config_key
    per_entity = changes.groupBy(col(config), col(schema.identifier).alias(key)).agg(
        F.count(F.lit(1)).alias("updated"), F.bool_or(_passed_on(changed_fields(changes))).alias("__passed")
    )
    # Both sides hold one row per entity and are already partitioned by it.
    there = distinct_keys(destination, [config, key]).withColumn("__there", F.lit(True))
    counted = keyed_join(per_entity, there, [config, key], unique=True).groupBy(config).agg(
        F.sum("updated").alias("updated"),
        F.count_if(col("__passed") & col("__there").isNotNull()).alias("propagated"),
        F.count_if(col("__passed") & col("__there").isNull()).alias("failed"),
    )
    base = configs.select(col("id").cast("string").alias(config))
    joined = keyed_join(base, counted, config, unique=True)
    number = {n: F.coalesce(col(n), F.lit(0)) for n in ("updated", "propagated", "failed")}
    return joined.select(
        config,
        *[v.alias(n) for n, v in number.items()],
        derived_status(number["updated"] + number["propagated"], number["failed"]).alias("status"),
    )


def sync_all(
    samples: DataFrame,
    source: DataFrame,
    destination: DataFrame,
    configs: DataFrame,
    schema: SchemaSpec,
    source_key: str,
    destination_key: str,
    as_of=None,
    stage: bool = True,
    **options,
) -> dict[str, DataFrame]:
    """Everything a sync run writes: ``samples``, ``destination`` and ``results``.

    The changes feed all three, so they are pinned with a checkpoint unless ``stage`` is off; they are
    unfolded to one row per field only for the report under ``changes``. A destination that is the source
    itself is refused: its values would come back to it.
    """
    if source is destination or source.sameSemantics(destination):
        raise ValueError("source and destination are the same table")
    changes = changes_for_configs(samples, source, configs, schema, source_key, as_of=as_of, **options)
    if stage:
        checkpoint_root(samples.sparkSession)
        changes = changes.checkpoint()
    return {
        "changes": unfolded(changes),
        "samples": apply_to_samples(samples, changes, schema, moment(as_of)),
        "destination": apply_to_destination(destination, changes, schema, destination_key, [schema.config_key]),
        "results": sync_results(changes, destination, configs, schema, destination_key),
    }
