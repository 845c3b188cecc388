"""Submission and workflow documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplyard.functions.columns import col
from samplyard.functions.dates import parse_wall

SUBMISSION = (
    "struct<submissionId:string, status:string, submissionDate:string, "
    "submissionEntity:struct<entityName:string>, "
    "workflows:array<struct<workflowId:string, status:string, workflowEntity:struct<entityName:string>>>>"
)


def parse_documents(text: DataFrame, column: str = "value") -> DataFrame:
    return text.select(F.from_json(col(column), SUBMISSION).alias("doc")).select("doc.*")


def submission_date(value: Column) -> Column:
    """Wall time of the document; the trailing Z carries no meaning."""
    return parse_wall(F.regexp_replace(value, "Z+$", ""))


def list_submissions(documents: DataFrame, skip_aborted: bool = True) -> DataFrame:
    """(submission_id, entity_name, submission_date, status); documents without entity are dropped."""
    rows = documents.filter(col("submissionEntity")["entityName"].isNotNull())
    if skip_aborted:
        rows = rows.filter(~col("status").eqNullSafe("Aborted"))
    return rows.select(
        col("submissionId").alias("submission_id"),
        col("submissionEntity")["entityName"].alias("entity_name"),
        submission_date(col("submissionDate")).alias("submission_date"),
        "status",
    )


def explode_workflows(documents: DataFrame, skip_aborted: bool = True, need_id: bool = True) -> DataFrame:
    """One row per workflow that names an entity, with its place in the submission.

    The set name is the submission's entity. A workflow without status is ``Unknown``.
    """
    rows = documents.select(
        col("submissionId").alias("submission_id"),
        submission_date(col("submissionDate")).alias("submission_date"),
        col("submissionEntity")["entityName"].alias("upload_source"),
        F.posexplode("workflows").alias("position", "workflow"),
    ).select(
        "submission_id",
        "submission_date",
        "upload_source",
        col("position").cast("bigint").alias("position"),
        col("workflow")["workflowId"].alias("workflow_id"),
        col("workflow")["workflowEntity"]["entityName"].alias("entity_name"),
        col("workflow")["status"].alias("raw_status"),
    )
    rows = rows.filter(col("entity_name").isNotNull())
    if need_id:
        rows = rows.filter(col("workflow_id").isNotNull())
    if skip_aborted:
        rows = rows.filter(~col("raw_status").eqNullSafe("Aborted"))
    return rows.withColumn("status", F.coalesce(col("raw_status"), F.lit("Unknown"))).drop("raw_status")
