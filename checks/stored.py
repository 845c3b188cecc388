"""Stored tables and streams into them: written in full, then read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.cleaning import CLEAN_COLUMNS, CLEAN_SQL, INTAKE, KNOWN, known_samples
from checks.configs import CONFIG
from checks.lookups import LOOK_BACK
from checks.registry import case
from checks.updates import BATCH, MINE, NOW, READY, RECORDS, SAMPLES, SYNC, bulk_sql, records, sync_changes, written
from checks.views import ORDERS_AS_OF
from samplyard.functions.columns import col
from samplyard.plans import ingest
from samplyard.session import work_path
from samplyard.sources import bucketed, grouped, store
from samplyard.streaming import ingest as stream_plan
from samplyard.streaming import stages, windows

UNKNOWN = f"AND NOT EXISTS (SELECT 1 FROM ({KNOWN}) k WHERE k.sample_id = r.entity_id)"


def updated(v):
    """The samples as a stored table, a third of them without a creation day, after all updates."""
    path = work_path(v.spark, "samples")
    yearly = F.when(col("entity_type").isNotNull(), F.date_trunc("year", "created_at").cast("timestamp_ntz"))
    store.append_rows(v.samples.withColumn("created_at", yearly), path)
    counts = store.update_rows(
        v.spark, path, records(v), SAMPLES, ORDERS_AS_OF, fields=["workflow_state", "upload_source"], batch_size=BATCH
    )
    return v.spark.read.parquet(path), counts


@case("stored_update", bulk_sql("state IS NOT NULL"), ("samples",))
def stored_update(v):
    return updated(v)[0].select("id", "workflow_state", "upload_source", "updated_at")


@case("stored_update_counts", f"""
WITH records AS ({RECORDS})
SELECT batch, count(*) FILTER (state IS NOT NULL OR has_source) AS applied, cast(0 AS bigint) AS unmatched,
       count(*) FILTER (state IS NULL AND NOT has_source) AS rejected FROM records GROUP BY 1""", ("samples",))
def stored_update_counts(v):
    return updated(v)[1]


# ---- the samples in buckets ----------------------------------------------------------------

def bucketed_table(v, rows, schema):
    """The rows as a bucketed table, by year of creation, a part of them without a day."""
    name = f"samples_{uuid.uuid4().hex}"
    bucketed.create_bucketed(v.spark, name, schema, 16, work_path(v.spark, "bucketed"))
    bucketed.append_bucketed(store.conform(rows, schema), name)
    return name


def in_years(rows, has_day):
    return rows.withColumn("created_at", F.when(has_day, F.date_trunc("year", "created_at").cast("timestamp_ntz")))


@case("bucketed_update", bulk_sql("state IS NOT NULL"), ("samples",))
def bucketed_update(v):
    name = bucketed_table(v, in_years(v.samples, col("entity_type").isNotNull()), SAMPLES)
    bucketed.update_bucketed(v.spark, name, records(v), SAMPLES, ORDERS_AS_OF, fields=["workflow_state", "upload_source"], batch_size=BATCH)
    return v.spark.table(name).select("id", "workflow_state", "upload_source", "updated_at")


@case("bucketed_marks", f"""
SELECT id, CASE WHEN uploaded_at IS NULL THEN {NOW} ELSE uploaded_at END AS uploaded_at,
       CASE WHEN uploaded_at IS NULL THEN 'again' ELSE upload_source END AS upload_source,
       CASE WHEN {READY} THEN {NOW} ELSE submitted_at END AS submitted_at,
       CASE WHEN {READY} THEN 'new_' || config_id ELSE submission_id END AS submission_id,
       CASE WHEN {READY} THEN 'Submitted' ELSE workflow_state END AS workflow_state,
       CASE WHEN uploaded_at IS NULL OR {READY} THEN {NOW} END AS updated_at FROM samples""", ("samples",))
def bucketed_marks(v):
    name = bucketed_table(v, in_years(v.samples, col("entity_type").isNotNull()), SAMPLES)
    ready = v.samples.filter(READY).select("id", F.concat(F.lit("new_"), "config_id").alias("submission_id"))
    bucketed.mark_uploaded(v.spark, name, v.samples.filter("uploaded_at IS NULL"), "again", SAMPLES, ORDERS_AS_OF)
    bucketed.mark_submitted(v.spark, name, ready, SAMPLES, ORDERS_AS_OF)
    return v.spark.table(name).select("id", "uploaded_at", "upload_source", "submitted_at", "submission_id", "workflow_state", "updated_at")


@case("bucketed_sync", f"""
WITH {MINE}
SELECT t.id, {written("lab")} AS lab, {written("stage")} AS stage, cast({written("total")} AS double) AS total,
       CASE WHEN t.id IN (SELECT id FROM mine) THEN {NOW} END AS updated_at
FROM sync_target t""", ("sync_target", "sync_source"))
def bucketed_sync(v):
    name = bucketed_table(v, in_years(v.sync_target, col("stage").isNotNull()), SYNC)
    bucketed.apply_sync(v.spark, name, sync_changes(v), SYNC, ORDERS_AS_OF)
    return v.spark.table(name).select("id", "lab", "stage", "total", "updated_at")


@case("incomplete_of_active", """
SELECT id, config_id, workflow_id, workflow_state FROM samples
WHERE coalesce(workflow_id, '') <> '' AND coalesce(workflow_state, '') NOT IN ('Succeeded', 'Failed', 'Aborted')
  AND config_id IN (SELECT id FROM configs WHERE active)""", ("samples", "configs"))
def incomplete_of_active(v):
    """From a table stored by config group and day; the active configs choose the groups."""
    path = work_path(v.spark, "grouped")
    yearly = F.date_trunc("year", "created_at").cast("timestamp_ntz")
    grouped.append_grouped(v.samples.withColumn("created_at", yearly), path, 16)
    samples, groups = grouped.read_grouped(v.spark, path)
    found = grouped.incomplete_of_active(samples, groups, v.configs, ORDERS_AS_OF, LOOK_BACK)
    return found.select("id", "config_id", "workflow_id", "workflow_state")


@case("insert_rows", """
SELECT id, name, active FROM configs UNION ALL SELECT 'new-1', 'first', true UNION ALL SELECT 'new-2', NULL, NULL""", ("configs",))
def insert_rows(v):
    path = work_path(v.spark, "configs")
    ingest.load_configs(v.configs, CONFIG, path, ORDERS_AS_OF, "overwrite")
    missing = v.configs.filter("entity_type IS NULL")
    store.append_rows(ingest.process_configs(missing, CONFIG, ORDERS_AS_OF), path)
    store.insert_rows(v.spark, [{"id": "new-1", "name": "first", "active": True, "created_at": "2024-01-01T00:00:00"}, {"id": "new-2"}], CONFIG, path)
    return v.spark.read.schema(CONFIG.struct).parquet(path).select("id", "name", "active")


@case("load_configs", """
SELECT id, name, entity_type, active, transferred, method_config, prefix, created_at, date '2024-01-01' AS created_date,
       (SELECT count(*) FROM configs WHERE entity_type IS NULL) AS refused
FROM configs WHERE entity_type IS NOT NULL""", ("configs",))
def load_configs(v):
    path = work_path(v.spark, "configs")
    counts = ingest.load_configs(v.configs, CONFIG, path, ORDERS_AS_OF)
    rows = v.spark.read.parquet(path).withColumn("refused", F.lit(counts["filtered"]).cast("bigint"))
    return rows.select("id", "name", "entity_type", "active", "transferred", "method_config", "prefix", "created_at", "created_date", "refused")


@case("load_samples", CLEAN_SQL + UNKNOWN, ("raw_orders", "configs", "samples"))
def load_samples(v):
    path = work_path(v.spark, "samples")
    cleaned = lambda raw: ingest.process_samples(
        raw, INTAKE, known=known_samples(v), configs=v.configs, config_column="config", entity_type="order", as_of=ORDERS_AS_OF
    )
    store.load_samples(v.raw, cleaned, path)
    return v.spark.read.parquet(path).select(*CLEAN_COLUMNS)


# ---- streams -------------------------------------------------------------------------------

def stream_of(v, name):
    """Stream over the file, or the files of the folder, of a table."""
    # The brackets make the name a pattern, which a stream resolves to a file and to a folder alike.
    files = f"{v.sf_dir}/{name}.parque[t]"
    return v.spark.readStream.schema(v.table(name).schema).option("maxFilesPerTrigger", "1").parquet(files)


@case("stream_ingest", CLEAN_SQL + UNKNOWN, ("raw_orders", "configs", "samples"))
def stream_ingest(v):
    path = work_path(v.spark, "samples")
    raw = v.view("raw_orders", orders=stream_of(v, "orders")).withColumnRenamed("entity_id", "entity:order_id")
    stream_plan.start_ingest(
        raw, INTAKE, path, work_path(v.spark, "offsets"), seed=lambda: known_samples(v),
        configs=v.configs, config_column="config", entity_type="order", as_of=ORDERS_AS_OF,
    ).awaitTermination()
    return stream_plan.read_table(v.spark, path, INTAKE).select(*CLEAN_COLUMNS)


@case("stream_lifecycle", """
SELECT id, created_at, uploaded_at, submitted_at,
       CASE WHEN submitted_at IS NOT NULL THEN 'submitted' WHEN uploaded_at IS NOT NULL THEN 'uploaded' ELSE 'created' END AS stage
FROM samples""", ("samples",))
def stream_lifecycle(v):
    out = work_path(v.spark, "stages")
    rows = v.view("samples", orders=stream_of(v, "orders"))
    windows.start_updates(windows.lifecycle(rows), out, work_path(v.spark, "offsets")).awaitTermination()
    return windows.latest_state(v.spark.read.parquet(out), ["id"]).select("id", "created_at", "uploaded_at", "submitted_at", "stage")


ENDED = "workflow_state IN ('Succeeded', 'Failed', 'Aborted')"


@case("stream_stages", f"""
SELECT id, created_at, uploaded_at, submitted_at, finished_at, CASE WHEN finished_at IS NOT NULL THEN workflow_state END AS outcome,
       CASE WHEN finished_at IS NOT NULL THEN 'finished' WHEN submitted_at IS NOT NULL THEN 'submitted'
            WHEN uploaded_at IS NOT NULL THEN 'uploaded' ELSE 'created' END AS stage
FROM (SELECT *, CASE WHEN {ENDED} THEN created_at + INTERVAL 3 DAY END AS finished_at FROM samples)""", ("samples",))
def stream_stages(v):
    """The events of a sample come in four files, later stages before earlier ones for many."""
    landing, out = work_path(v.spark, "events"), work_path(v.spark, "stages")
    finished = F.expr(f"CASE WHEN {ENDED} THEN created_at + INTERVAL 3 DAY END")
    times = {"created": "created_at", "uploaded": "uploaded_at", "submitted": "submitted_at", "finished": finished}
    events = stages.stage_events(v.samples, times, "workflow_state")
    events.withColumn("file", F.pmod(F.xxhash64("id", "stage"), F.lit(4))).write.partitionBy("file").parquet(landing)
    rows = v.spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "8").parquet(landing)
    stages.start_stages(rows, out, work_path(v.spark, "offsets"), late="36500 days").awaitTermination()
    return stages.current_stages(v.spark.read.parquet(out))


@case("stream_repeats", "SELECT DISTINCT user_id FROM events")
def stream_repeats(v):
    out = work_path(v.spark, "users")
    # Files come in any order, so the bound spans all the times there can be.
    rows = windows.without_repeats(windows.event_time(stream_of(v, "events"), "ts"), "ts", "user_id", "36500 days")
    windows.start_appends(rows, out, work_path(v.spark, "offsets")).awaitTermination()
    return v.spark.read.parquet(out).select("user_id")
