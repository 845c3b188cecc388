"""Operational counts. Every group is reduced to numbers before it is shuffled or joined;
the members of a group come as rows of their own, never as one array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplyard.functions.columns import col
from samplyard.functions.paths import bucket_of, is_object_path, key_of
from samplyard.operators.joins import keyed_join


def _counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_samples"),
        F.count(col("uploaded_at")).alias("uploaded_samples"),
        F.count(col("submitted_at")).alias("submitted_samples"),
    ]


def totals(samples: DataFrame) -> DataFrame:
    return samples.agg(*_counts())


def by_entity_type(samples: DataFrame) -> DataFrame:
    """Samples per entity type; rows without one are left out."""
    return (
        samples.filter(col("entity_type").isNotNull())
        .groupBy("entity_type")
        .agg(F.count(F.lit(1)).alias("sample_count"))
    )


def entity_members(samples: DataFrame, identifier: str) -> DataFrame:
    """(entity type, sample) rows behind :func:`by_entity_type`."""
    return samples.filter(col("entity_type").isNotNull()).select("entity_type", col(identifier).alias("sample_id"))


def by_config(
    samples: DataFrame,
    configs: DataFrame,
    name_column: str | None = None,
    config_key: str = "config_id",
) -> DataFrame:
    """Counts per config with its display name and entity type.

    The name falls back to ``Config <id>``, the type to ``Unknown``. Entity types are counted in
    two steps, so a config with very many samples is spread by its types first.
    """
    grouped = (
        samples.filter(col(config_key).isNotNull())
        .groupBy(col(config_key), col("entity_type"))
        .agg(*_counts())
        .groupBy(col(config_key))
        .agg(
            *[F.sum(n).alias(n) for n in ("total_samples", "uploaded_samples", "submitted_samples")],
            F.count(col("entity_type")).alias("entity_types"),
        )
    )
    name = col(name_column) if name_column else F.lit(None).cast("string")
    labels = configs.select(
        col("id").alias(config_key), name.alias("config_name"), col("entity_type").alias("config_entity_type")
    )
    labelled = keyed_join(grouped, labels, config_key)
    return labelled.withColumns(
        {
            "config_name": F.coalesce(col("config_name"), F.concat(F.lit("Config "), col(config_key))),
            "config_entity_type": F.coalesce(col("config_entity_type"), F.lit("Unknown")),
        }
    )


def config_entity_types(samples: DataFrame, config_key: str = "config_id") -> DataFrame:
    """Distinct (config, entity type) pairs."""
    return samples.filter(col(config_key).isNotNull()).select(config_key, "entity_type").distinct()


def rollup_counts(samples: DataFrame, config_key: str = "config_id") -> DataFrame:
    """Grand total, totals per entity type and totals per config of a type in one pass."""
    return samples.rollup("entity_type", config_key).agg(F.grouping_id().alias("level"), *_counts())


def state_summary(samples: DataFrame, config_key: str = "config_id", state: str = "workflow_state") -> DataFrame:
    """Samples per config and workflow state; a null state counts as ``None``."""
    return samples.groupBy(
        col(config_key), F.coalesce(col(state), F.lit("None")).alias(state)
    ).agg(F.count(F.lit(1)).alias("samples"))


def derived_status(successes: Column, failures: Column) -> Column:
    """Status of a batch from its numbers of successes and failures."""
    some, failed = successes > 0, failures > 0
    return (
        F.when(some & failed, "partial_success")
        .when(some, "success")
        .when(failed, "error")
        .otherwise("no_updates")
    )


def status_rollup(results: DataFrame) -> DataFrame:
    """Configs and samples per result status."""
    return results.groupBy("status").agg(
        F.count(F.lit(1)).alias("configs"),
        F.sum("total_samples").alias("samples"),
    )


def merged_states(per_config: DataFrame, state: str = "workflow_state", count: str = "samples") -> DataFrame:
    """State counts of all configs together."""
    return per_config.groupBy(col(state)).agg(F.sum(col(count)).alias(count))


def uri_inventory(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct object paths per (column, bucket); a path without a key fails the job."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("uri")) for c in columns])
    uris = df.select(F.inline(pairs)).filter(is_object_path(col("uri"))).distinct()
    checked = F.when(
        F.locate("/", F.substring(col("uri"), 6, 2**31 - 1)) == 0,
        F.raise_error(F.concat(F.lit("object path without a key: "), col("uri"))).cast("string"),
    ).otherwise(key_of(col("uri")))
    return uris.select("column", bucket_of(col("uri")).alias("bucket"), checked.alias("key"))

