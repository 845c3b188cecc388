"""Keyed updates and metadata sync."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import case
from checks.views import ORDERS_AS_OF
from samplyard.functions.columns import col
from samplyard.operators import sync, update
from samplyard.plans import sync as sync_plan
from samplyard.schema import SchemaSpec

NOW = f"timestamp '{ORDERS_AS_OF}'"

SAMPLES = SchemaSpec.from_yaml("""
fields:
  id: {type: string, required: true, primary_key: true, system_value: true}
  sample_id: {type: string, required: true, sample_identifier: true}
  config_id: {type: string, configuration_identifier: true}
  entity_type: {type: string}
  created_at: {type: datetime, system_value: true}
  updated_at: {type: datetime, system_value: true}
  uploaded_at: {type: datetime}
  submitted_at: {type: datetime}
  upload_source: {type: string}
  submission_id: {type: string}
  workflow_id: {type: string}
  workflow_state: {type: string}
""")

SYNC = SchemaSpec.from_yaml("""
fields:
  id: {type: string, required: true, primary_key: true}
  sample_id: {type: string, required: true, sample_identifier: true}
  config_id: {type: string, configuration_identifier: true}
  created_at: {type: datetime}
  updated_at: {type: datetime}
  lab: {type: string, sync_field: true}
  stage: {type: string, sync_field: true}
  total: {type: float, sync_field: true, column_mappings: [src_total]}
""")

# Every line item is one update record for the sample of its order.
BATCH = 5_000_000
PLACE = "l_partkey * 10000 + l_suppkey * 10 + l_linenumber"
RECORDS = f"""
SELECT cast(l_orderkey AS string) AS id, {PLACE} AS place, ({PLACE}) // {BATCH} AS batch,
       CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'R' THEN 'Returned' END AS state,
       l_quantity >= 10 AS has_source, 'up_' || l_linestatus AS source FROM lineitem"""


def records(v):
    state = F.when(col("l_returnflag") == "A", "Accepted").when(col("l_returnflag") == "R", "Returned")
    source = F.when(
        col("l_quantity") >= 10, F.create_map(F.lit("upload_source"), F.concat(F.lit("up_"), "l_linestatus"))
    ).otherwise(F.create_map().cast("map<string,string>"))
    return v.lineitem.select(
        col("l_orderkey").cast("string").alias("id"),
        (col("l_partkey") * 10000 + col("l_suppkey") * 10 + col("l_linenumber")).cast("bigint").alias(update.POSITION),
        F.map_concat(F.create_map(F.lit("workflow_state"), state), source).alias(update.CHANGES),
    )


def bulk_sql(state_present):
    pick = "SELECT id, {v} AS v FROM records WHERE {p} QUALIFY row_number() OVER (PARTITION BY id ORDER BY batch DESC, place) = 1"
    return f"""
WITH records AS ({RECORDS}),
st AS ({pick.format(v="state", p=state_present)}), so AS ({pick.format(v="source", p="has_source")})
SELECT s.id, CASE WHEN st.id IS NOT NULL THEN st.v ELSE s.workflow_state END AS workflow_state,
       CASE WHEN so.id IS NOT NULL THEN so.v ELSE s.upload_source END AS upload_source,
       CASE WHEN st.id IS NOT NULL OR so.id IS NOT NULL THEN {NOW} END AS updated_at
FROM samples s LEFT JOIN st ON s.id = st.id LEFT JOIN so ON s.id = so.id"""


def bulk(v, allow_nulls):
    done = update.apply_records(
        v.samples, records(v), SAMPLES, ORDERS_AS_OF, fields=["workflow_state", "upload_source"],
        allow_nulls=allow_nulls, batch_size=BATCH,
    )
    return done.select("id", "workflow_state", "upload_source", "updated_at")


@case("bulk_update", bulk_sql("state IS NOT NULL"), ("samples",))
def bulk_update(v):
    return bulk(v, False)


@case("bulk_update_nulls", bulk_sql("true"), ("samples",))
def bulk_update_nulls(v):
    return bulk(v, True)


@case("update_accounting", f"""
WITH records AS ({RECORDS})
SELECT batch, count(*) FILTER (NOT rejected AND hit) AS applied, count(*) FILTER (NOT rejected AND NOT hit) AS unmatched,
       count(*) FILTER (rejected) AS rejected
FROM (SELECT batch, state IS NULL AND NOT has_source AS rejected,
             id IN (SELECT id FROM samples WHERE uploaded_at IS NOT NULL) AS hit FROM records) t GROUP BY 1""", ("samples",))
def update_accounting(v):
    return update.accounting(v.samples.filter("uploaded_at IS NOT NULL"), records(v), SAMPLES, batch_size=BATCH)


WAITING = "uploaded_at IS NULL AND entity_type IS NOT NULL"


@case("mark_uploaded", f"""
SELECT id, CASE WHEN {WAITING} THEN {NOW} ELSE uploaded_at END AS uploaded_at,
       CASE WHEN {WAITING} THEN 'lab_20240130' ELSE upload_source END AS upload_source,
       CASE WHEN {WAITING} THEN {NOW} END AS updated_at FROM samples""", ("samples",))
def mark_uploaded(v):
    done = update.mark_uploaded(v.samples, v.samples.filter(WAITING), "lab_20240130", ORDERS_AS_OF)
    return done.select("id", "uploaded_at", "upload_source", "updated_at")


READY = "uploaded_at IS NOT NULL AND submitted_at IS NULL"


@case("mark_submitted", f"""
SELECT id, CASE WHEN {READY} THEN {NOW} ELSE submitted_at END AS submitted_at,
       CASE WHEN {READY} THEN 'new_' || config_id ELSE submission_id END AS submission_id,
       CASE WHEN {READY} THEN 'Submitted' ELSE workflow_state END AS workflow_state FROM samples""", ("samples",))
def mark_submitted(v):
    ready = v.samples.filter(READY).select("id", F.concat(F.lit("new_"), "config_id").alias("submission_id"))
    done = update.mark_submitted(v.samples, ready, ORDERS_AS_OF)
    return done.select("id", "submitted_at", "submission_id", "workflow_state")


# ---- sync ----------------------------------------------------------------------------------

TEXT = "coalesce({c}, '')"


def sync_sql(overwrite, clear):
    parts = []
    for field, new, old in (
        ("lab", "s.lab", "t.lab"), ("stage", "s.stage", "t.stage"),
        ("total", "try_cast(s.src_total AS double)", "t.total"),
    ):
        empty_new = f"coalesce(cast({new} AS string), '') = ''"
        empty_old = f"coalesce(cast({old} AS string), '') = ''"
        write = f"NOT {empty_new} AND ({empty_old}" + (f" OR {new} <> {old}" if overwrite else "") + ")"
        parts.append(
            f"SELECT t.id, t.sample_id, '{field}' AS field, CASE WHEN NOT {empty_new} THEN cast({new} AS string) END AS value, "
            f"NOT {empty_new} AS propagate FROM sync_target t JOIN sync_source s ON t.sample_id = s.entity_id AND s.version = 1 "
            f"WHERE ({write})" + (f" OR ({empty_new} AND NOT {empty_old})" if clear else "")
        )
    return " UNION ALL ".join(parts)


def synced(v, overwrite, clear):
    source = v.sync_source.select(col("entity_id").alias("entity:order_id"), "lab", "stage", "src_total", "version")
    return sync.field_changes(
        v.sync_target, source, SYNC, SYNC.sync_fields, "sample_id", overwrite, clear, tie_break=["version"]
    )


for name, overwrite, clear in (("sync_fill", False, False), ("sync_overwrite", True, False), ("sync_clear", True, True)):
    case(name, sync_sql(overwrite, clear), ("sync_target", "sync_source"))(
        lambda v, o=overwrite, c=clear: synced(v, o, c)
    )


CHANGED = "changed AS (" + sync_sql(True, True) + ")"
ACTIVE = "SELECT cast(c_custkey AS string) AS id FROM customer WHERE c_acctbal > 0"
DESTINATION = "SELECT sample_id AS entity, config_id, lab, stage FROM sync_target WHERE total IS NOT NULL"


def sync_changes(v):
    """What the sync run of the active configs writes, one row per sample."""
    source = v.sync_source.select(col("entity_id").alias("entity:order_id"), "config_id", "lab", "stage", "src_total", "version")
    return sync_plan.changes_for_configs(
        v.sync_target, source, v.configs.filter("active"), SYNC, "entity:order_id",
        as_of=ORDERS_AS_OF, days_back=10_000, overwrite=True, allow_null=True, tie_break=["version"],
    )


def sync_run(v):
    source = v.sync_source.select(col("entity_id").alias("entity:order_id"), "config_id", "lab", "stage", "src_total", "version")
    destination = v.sync_target.filter("total IS NOT NULL").select(col("sample_id").alias("entity"), "config_id", "lab", "stage")
    return sync_plan.sync_all(
        v.sync_target, source, destination, v.configs.filter("active"), SYNC, "entity:order_id", "entity",
        as_of=ORDERS_AS_OF, days_back=10_000, overwrite=True, allow_null=True, tie_break=["version"], stage=False,
    )


def written(field):
    return f"""CASE WHEN EXISTS (SELECT 1 FROM mine c WHERE c.id = t.id AND c.field = '{field}')
        THEN (SELECT c.value FROM mine c WHERE c.id = t.id AND c.field = '{field}') ELSE cast(t.{field} AS string) END"""


MINE = f"{CHANGED}, mine AS (SELECT c.*, t.config_id FROM changed c JOIN sync_target t ON c.id = t.id WHERE t.config_id IN ({ACTIVE}))"


@case("sync_apply", f"""
WITH {MINE},
wide AS (SELECT id, max(value) FILTER (field = 'lab') AS lab, max(value) FILTER (field = 'stage') AS stage,
                max(value) FILTER (field = 'total') AS total, bool_or(field = 'lab') AS has_lab,
                bool_or(field = 'stage') AS has_stage, bool_or(field = 'total') AS has_total FROM mine GROUP BY 1)
SELECT t.id, CASE WHEN has_lab THEN w.lab ELSE t.lab END AS lab, CASE WHEN has_stage THEN w.stage ELSE t.stage END AS stage,
       CASE WHEN has_total THEN cast(w.total AS double) ELSE t.total END AS total,
       CASE WHEN w.id IS NOT NULL THEN {NOW} END AS updated_at
FROM sync_target t LEFT JOIN wide w ON t.id = w.id""", ("sync_target", "sync_source"))
def sync_apply(v):
    return sync_run(v)["samples"].select("id", "lab", "stage", "total", "updated_at")


@case("sync_propagate", f"""
WITH {MINE},
wide AS (SELECT sample_id, config_id, max(value) FILTER (field = 'lab') AS lab, max(value) FILTER (field = 'stage') AS stage
         FROM mine WHERE propagate GROUP BY 1, 2)
SELECT d.entity, d.config_id, coalesce(w.lab, d.lab) AS lab, coalesce(w.stage, d.stage) AS stage
FROM ({DESTINATION}) d LEFT JOIN wide w ON d.entity = w.sample_id AND d.config_id = w.config_id""", ("sync_target", "sync_source"))
def sync_propagate(v):
    return sync_run(v)["destination"].select("entity", "config_id", "lab", "stage")


@case("sync_results", f"""
WITH {MINE}, a AS ({ACTIVE}),
per AS (SELECT config_id, sample_id, id, bool_or(propagate) AS propagate FROM mine GROUP BY 1, 2, 3),
counts AS (SELECT config_id, count(*) AS updated, count(*) FILTER (propagate AND d.entity IS NOT NULL) AS propagated,
                  count(*) FILTER (propagate AND d.entity IS NULL) AS failed
           FROM per LEFT JOIN (SELECT entity FROM ({DESTINATION}) x) d ON per.sample_id = d.entity GROUP BY 1)
SELECT a.id AS config_id, coalesce(updated, 0) AS updated, coalesce(propagated, 0) AS propagated, coalesce(failed, 0) AS failed,
       CASE WHEN coalesce(updated, 0) + coalesce(propagated, 0) > 0 THEN CASE WHEN failed > 0 THEN 'partial_success' ELSE 'success' END
            WHEN failed > 0 THEN 'error' ELSE 'no_updates' END AS status
FROM a LEFT JOIN counts ON a.id = counts.config_id""", ("sync_target", "sync_source"))
def sync_results(v):
    return sync_run(v)["results"]
