"""Submissions and workflows: attaching states and refreshing them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplyard.functions.columns import col, cols, is_blank
from samplyard.operators.joins import complete, first_per_key, keyed_join, with_keys
from samplyard.operators.lookup import FINAL_STATES


def workflow_order() -> list[Column]:
    """Later submissions, then later places in the submission, win."""
    return [col("submission_date"), col("submission_id"), col("position"), col("workflow_id")]


def last_by_entity(workflows: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """The workflow that stands last for every entity."""
    return first_per_key(workflows, [*(scope or []), "entity_name"], workflow_order(), last=True)


def workflows_by_entity(workflows: DataFrame, entities: DataFrame, skip_aborted: bool = True) -> DataFrame:
    """Last workflow of each listed entity."""
    rows = workflows.filter(~col("status").eqNullSafe("Aborted")) if skip_aborted else workflows
    return last_by_entity(with_keys(rows, entities, ["entity_name"]))


def attach_workflows(
    samples: DataFrame,
    workflows: DataFrame,
    identifier: str,
    scope: list[str] | None = None,
    key: str = "id",
) -> DataFrame:
    """(id, workflow id, state) for samples whose entity has a workflow; aborted ones included.

    A workflow without id gives '', one without status ``Unknown``.
    """
    left = samples.select(col(key), *cols(scope or []), col(identifier))
    return keyed_join(left, state_by_entity(workflows, identifier, scope), [*(scope or []), identifier], "inner")


def state_by_entity(workflows: DataFrame, identifier: str, scope: list[str] | None = None) -> DataFrame:
    """(scope.., identifier, new workflow id, new state): the last workflow of every entity."""
    last = last_by_entity(workflows, scope).withColumnRenamed("entity_name", identifier)
    return last.select(
        *cols(scope or []),
        col(identifier),
        F.coalesce(col("workflow_id"), F.lit("")).alias("new_workflow_id"),
        F.coalesce(col("status"), F.lit("Unknown")).alias("new_state"),
    )


def refresh_states(
    incomplete: DataFrame,
    workflows: DataFrame,
    key: str = "id",
    submission: str = "submission_id",
    workflow: str = "workflow_id",
) -> DataFrame:
    """(id, state) of unfinished samples, looked up by submission and workflow id."""
    left = incomplete.select(col(key), col(submission), col(workflow))
    return keyed_join(left, state_by_workflow(workflows, submission, workflow), [submission, workflow], "inner")


def state_by_workflow(workflows: DataFrame, submission: str = "submission_id", workflow: str = "workflow_id") -> DataFrame:
    """(submission, workflow, new state): where a workflow is listed more than once, its first place."""
    listed = workflows.filter(col("workflow_id").isNotNull())
    first = first_per_key(
        listed.select("submission_id", "workflow_id", "position", "status"),
        ["submission_id", "workflow_id"],
        [col("position"), col("status")],
    )
    return first.select(
        col("submission_id").alias(submission),
        col("workflow_id").alias(workflow),
        F.coalesce(col("status"), F.lit("Unknown")).alias("new_state"),
    )


def is_unfinished(state: Column) -> Column:
    return is_blank(state) | ~state.isin(*FINAL_STATES)


def backfill_submissions(samples: DataFrame, workflows: DataFrame, identifier: str, submission: str = "submission_id") -> DataFrame:
    """Newest succeeded workflow for every sample that has no submission id."""
    done = workflows.filter((col("status") == "Succeeded") & col("entity_name").isNotNull())
    newest = first_per_key(
        done.select("entity_name", "submission_date", "submission_id", "position", "workflow_id", "status"),
        ["entity_name"],
        workflow_order(),
        last=True,
    )
    side = newest.select(
        col("entity_name").alias(identifier),
        col("submission_id").alias("new_submission_id"),
        col("workflow_id").alias("new_workflow_id"),
        col("status").alias("new_state"),
        col("submission_date").alias("new_submitted_at"),
    )
    missing = samples.filter(col(submission).isNull()).select("id", col(identifier))
    return keyed_join(missing, side, identifier, "inner")


def backfill_column(target: DataFrame, other: DataFrame, column: str, key: str, other_key: str | None = None, tie_break: str | None = None) -> DataFrame:
    """Fill nulls of one column from another table by key; of repeated keys the first non-null counts."""
    other_key = other_key or key
    side = other.filter(col(column).isNotNull()).select(
        col(other_key).alias(key),
        col(column).alias("__fill"),
        col(tie_break or column).alias("__tie"),
    )
    first = first_per_key(complete(side, [key]), [key], [col("__tie")]).drop("__tie")
    joined = keyed_join(target, first, key)
    return joined.select(
        *[F.coalesce(col(n), col("__fill")).alias(n) if n == column else col(n) for n in target.columns]
    )
