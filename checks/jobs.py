"""Whole ingest jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.cleaning import HAS_FILE, INTAKE, PATTERN, VALID_DATE
from checks.registry import case
from checks.views import ORDERS_AS_OF
from samplyard.plans import ingest

NOW = f"timestamp '{ORDERS_AS_OF}'"
ACTIVE = "(SELECT * FROM configs WHERE active)"
KNOWN_ID = "SELECT sample_id FROM samples WHERE entity_type = '2-HIGH'"


@case("ingest_all_configs", f"""
WITH screened AS (
  SELECT r.config, {HAS_FILE} AND {PATTERN} AND {VALID_DATE} AND NOT coalesce(r.entity_id IN ({KNOWN_ID}), false) AS ok FROM raw_orders r),
loaded AS (SELECT config, count(*) FILTER (ok) AS loaded, count(*) FILTER (NOT ok) AS filtered FROM screened GROUP BY 1),
due AS (SELECT config_id, count(*) AS due FROM samples WHERE uploaded_at IS NULL AND submitted_at IS NULL AND cast(created_at AS date) >= date '2001-08-01' - 400 GROUP BY 1)
SELECT c.id AS config_id,
       CASE WHEN l.config IS NULL THEN 'no_data' WHEN l.loaded + coalesce(d.due, 0) = 0 THEN 'no_new_samples' ELSE 'success' END AS status,
       coalesce(l.loaded, 0) AS loaded_count, coalesce(l.filtered, 0) AS filtered_count,
       CASE WHEN l.config IS NULL THEN 0 ELSE l.loaded + coalesce(d.due, 0) END AS uploaded_count,
       CASE WHEN l.config IS NOT NULL AND l.loaded + coalesce(d.due, 0) > 0 THEN c.prefix || '_20010801_120000' END AS set_name
FROM {ACTIVE} c LEFT JOIN loaded l ON c.id = l.config LEFT JOIN due d ON c.id = d.config_id""", ("raw_orders", "configs", "samples"))
def ingest_all_configs(v):
    active = v.configs.filter("active")
    ours = v.raw.join(active.select(F.col("id").alias("config")), "config", "left_semi").select(*v.raw.columns)
    screened = ingest.screen_samples(ours, INTAKE, v.samples.filter("entity_type = '2-HIGH'"), active, "config", "order")
    waiting = ingest.waiting_for_upload(v.samples, "custom", ORDERS_AS_OF, days_back=400)
    return ingest.ingest_results(screened, waiting, active, "prefix", ORDERS_AS_OF)


@case("ingest_rows", f"""
SELECT r.entity_id AS sample_id, c.id AS config_id, c.entity_type AS entity_type, r.priority AS priority, {NOW} AS created_at
FROM raw_orders r JOIN {ACTIVE} c ON r.config = c.id
WHERE {HAS_FILE} AND {PATTERN} AND {VALID_DATE} AND NOT coalesce(r.entity_id IN ({KNOWN_ID}), false)""", ("raw_orders", "configs", "samples"))
def ingest_rows(v):
    done = ingest.ingest_all(
        v.raw, v.configs.filter("active"), v.samples.filter("entity_type = '2-HIGH'"), INTAKE, "config", "prefix", "order", as_of=ORDERS_AS_OF
    )
    return done["rows"].select("sample_id", "config_id", "entity_type", "priority", "created_at")


@case("publish_sets", f"""
SELECT s.id, c.prefix || '_20010801_120000' AS upload_source, {NOW} AS uploaded_at
FROM samples s JOIN {ACTIVE} c ON s.config_id = c.id WHERE s.uploaded_at IS NULL
UNION ALL SELECT s.id, s.upload_source, s.uploaded_at FROM samples s LEFT JOIN {ACTIVE} c ON s.config_id = c.id
WHERE s.uploaded_at IS NOT NULL OR c.id IS NULL""", ("samples", "configs"))
def publish_sets(v):
    waiting = ingest.waiting_for_upload(v.samples, "custom", ORDERS_AS_OF, days_back=10_000)
    published = ingest.upload_sets(waiting, v.configs.filter("active"), "prefix", ORDERS_AS_OF)
    return ingest.mark_sets_uploaded(v.samples, published, ORDERS_AS_OF).select("id", "upload_source", "uploaded_at")


READY = "uploaded_at IS NOT NULL AND submitted_at IS NULL"


@case("single_table_flow", f"""
SELECT id, CASE WHEN {READY} AND config_id IN (SELECT id FROM configs WHERE active) THEN {NOW} ELSE submitted_at END AS submitted_at,
       CASE WHEN {READY} AND config_id IN (SELECT id FROM configs WHERE active) THEN 'run/' || config_id || '/' || upload_source ELSE submission_id END AS submission_id,
       CASE WHEN {READY} AND config_id IN (SELECT id FROM configs WHERE active) THEN 'Submitted' ELSE workflow_state END AS workflow_state
FROM samples""", ("samples", "configs"))
def single_table_flow(v):
    sets = v.samples.select("config_id", F.col("upload_source").alias("set_name")).dropna().distinct()
    active = v.configs.filter("active").select(F.col("id").alias("config_id"))
    given = sets.join(active, "config_id", "left_semi").withColumn(
        "submission_id", F.concat_ws("/", F.lit("run"), "config_id", "set_name")
    )
    done = ingest.single_table_flow(v.samples, given, "sample_id", "custom", ORDERS_AS_OF, days_back=10_000)
    return done["samples"].select("id", "submitted_at", "submission_id", "workflow_state")
