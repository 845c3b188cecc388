"""Refreshing workflow ids and states of all configs in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplyard.functions.columns import col
from samplyard.operators import lookup, update
from samplyard.operators.clean import moment
from samplyard.operators.joins import keyed_join
from samplyard.operators.workflows import state_by_entity, state_by_workflow


def refresh(
    samples: DataFrame,
    workflows: DataFrame,
    configs: DataFrame,
    identifier: str,
    as_of=None,
    days_back: int = 30,
    config_key: str = "config_id",
) -> DataFrame:
    """Samples of the given configs after both steps: attach missing ids, then refresh states.

    ``workflows`` lists all workflows with their submission, aborted ones included. Only samples
    that changed are returned, as (id, workflow_id, workflow_state). Workflows are joined to the
    samples themselves, first by entity, then by workflow, so no sample is joined to its own table.
    """
    low = moment(as_of) - F.make_dt_interval(days=F.lit(days_back))
    pending = lookup.unique_submissions(samples, as_of, days_back, config_key=config_key)
    listed = keyed_join(workflows, pending, "submission_id", "inner")
    attached = state_by_entity(listed, identifier, [config_key])
    ours = keyed_join(
        samples, configs.select(col("id").cast("string").alias(config_key)), config_key, "left_semi"
    )
    after = keyed_join(ours, attached, [config_key, identifier]).withColumns(
        {
            "__attached": col("new_state").isNotNull(),
            "workflow_id": F.coalesce(col("new_workflow_id"), col("workflow_id")),
            "workflow_state": F.coalesce(col("new_state"), col("workflow_state")),
        }
    ).drop("new_workflow_id", "new_state")
    running = F.coalesce(lookup.is_running() & (col("created_at") >= low), F.lit(False))
    touched = after.withColumn("__running", running).filter(col("__attached") | col("__running"))
    final = keyed_join(touched, state_by_workflow(workflows), ["submission_id", "workflow_id"])
    refreshed = F.when(col("__running"), col("new_state"))
    return final.filter(col("__attached") | refreshed.isNotNull()).select(
        "id",
        col(config_key),
        "workflow_id",
        F.coalesce(refreshed, col("workflow_state")).alias("workflow_state"),
    )


def apply_refresh(samples: DataFrame, refreshed: DataFrame, as_of=None) -> DataFrame:
    values = {"workflow_id": "$workflow_id", "workflow_state": "$workflow_state"}
    return update.set_fields(samples, refreshed, values, as_of)


def state_counts(refreshed: DataFrame, config_key: str = "config_id") -> DataFrame:
    """Refreshed samples per config and state."""
    return refreshed.groupBy(col(config_key), "workflow_state").agg(F.count(F.lit(1)).alias("samples"))
