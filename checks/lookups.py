"""Lookups and summaries over samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import case
from checks.views import ORDERS_AS_OF
from samplyard.functions.columns import col
from samplyard.functions.dates import utc_wall
from samplyard.operators import lookup, summary

NOW = f"timestamp '{ORDERS_AS_OF}'"
DAY = "date '2001-08-01'"
COLUMNS = "id, sample_id, created_at, uploaded_at"
PICK = COLUMNS.split(", ")
LOOK_BACK = 10_000  # days: the whole table


def timeframe(name, condition, **arguments):
    @case(name, f"SELECT {COLUMNS} FROM samples WHERE {condition}", ("samples",))
    def query(v):
        return lookup.samples_in(v.samples, as_of=ORDERS_AS_OF, newest_first=False, **arguments).select(*PICK)


timeframe("tf_today", f"cast(created_at AS date) = {DAY}", timeframe="today", uploaded="all", submitted="all")
timeframe("tf_yesterday", f"cast(created_at AS date) = {DAY} - 1", timeframe="yesterday", uploaded="all", submitted="all")
timeframe("tf_week", f"cast(created_at AS date) >= {DAY} - 7", timeframe="week", uploaded="all", submitted="all")
timeframe("tf_month", f"cast(created_at AS date) >= {DAY} - 30", timeframe="month", uploaded="all", submitted="all")
timeframe("tf_hourly", f"created_at >= {NOW} - INTERVAL 36 HOUR", timeframe="hourly", hours_back=36, uploaded="all", submitted="all")
timeframe(
    "tf_custom_range",
    "created_at BETWEEN timestamp '1996-02-01 00:00:00' AND timestamp '1999-03-01 00:00:00'",
    timeframe="custom", start="1996-02-01 00:00:00", end="1999-03-01 00:00:00", uploaded="all", submitted="all",
)
timeframe(
    "lifecycle_filter", "uploaded_at IS NOT NULL AND submitted_at IS NULL",
    timeframe="custom", days_back=LOOK_BACK, uploaded="uploaded", submitted="not_submitted",
)


@case("ready_for_submission", f"""
SELECT {COLUMNS} FROM samples
WHERE uploaded_at IS NOT NULL AND submitted_at IS NULL AND upload_source = 'set_2-HIGH'""", ("samples",))
def ready_for_submission(v):
    return lookup.ready_for_submission(
        v.samples, "custom", ORDERS_AS_OF, days_back=LOOK_BACK, set_name="set_2-HIGH", newest_first=False
    ).select(*PICK)


@case("query_samples", """
SELECT id, sample_id, created_at FROM samples
WHERE entity_type = '2-HIGH' AND created_at >= timestamp '1997-05-01 00:00:00' ORDER BY created_at DESC, id LIMIT 500""", ("samples",))
def query_samples(v):
    return lookup.query_samples(
        v.samples,
        ["entity_type = @kind", col("created_at") >= F.lit("1997-05-01").cast("timestamp_ntz")],
        {"kind": "2-HIGH"},
        ["id", "sample_id", "created_at"],
        "created_at DESC, id",
        500,
    )


@case("topk_recent", """
SELECT config_id, id, created_at FROM samples WHERE uploaded_at IS NULL
QUALIFY row_number() OVER (PARTITION BY config_id ORDER BY created_at DESC, id) <= 3""", ("samples",))
def topk_recent(v):
    return lookup.recent_not_uploaded(v.samples, 3).select("config_id", "id", "created_at")


@case("existing_ids", "SELECT DISTINCT sample_id FROM samples WHERE sample_id IS NOT NULL AND config_id = '42'", ("samples",))
def existing_ids(v):
    return lookup.existing_identifiers(v.samples, "sample_id", "42")


@case("existing_ids_all", "SELECT DISTINCT upload_source FROM samples WHERE upload_source IS NOT NULL", ("samples",))
def existing_ids_all(v):
    return lookup.existing_identifiers(v.samples, "upload_source")


@case("point_lookup", "SELECT sample_id, config_id, created_at FROM samples WHERE sample_id = 'S77'", ("samples",))
def point_lookup(v):
    from samplyard.sources.entities import entity_by_name

    return entity_by_name(v.samples, "S77", "sample_id").select("sample_id", "config_id", "created_at")


@case("unique_submissions", """
SELECT DISTINCT config_id, submission_id FROM samples
WHERE coalesce(submission_id, '') <> '' AND coalesce(workflow_id, '') = ''""", ("samples",))
def unique_submissions(v):
    return lookup.unique_submissions(v.samples, ORDERS_AS_OF, LOOK_BACK)


@case("incomplete_workflows", """
SELECT id, workflow_id, workflow_state FROM samples
WHERE coalesce(workflow_id, '') <> '' AND coalesce(workflow_state, '') NOT IN ('Succeeded', 'Failed', 'Aborted')
""", ("samples",))
def incomplete_workflows(v):
    return lookup.incomplete_workflows(v.samples, ORDERS_AS_OF, LOOK_BACK).select("id", "workflow_id", "workflow_state")


@case("incomplete_workflows_limit", """
SELECT id, workflow_id, workflow_state FROM samples
WHERE coalesce(workflow_id, '') <> '' AND coalesce(workflow_state, '') NOT IN ('Succeeded', 'Failed', 'Aborted')
QUALIFY row_number() OVER (PARTITION BY config_id ORDER BY created_at DESC, id) <= 1""", ("samples",))
def incomplete_workflows_limit(v):
    return lookup.incomplete_workflows(v.samples, ORDERS_AS_OF, LOOK_BACK, 1).select("id", "workflow_id", "workflow_state")


COUNTS = "count(*) AS total_samples, count(uploaded_at) AS uploaded_samples, count(submitted_at) AS submitted_samples"


@case("summary_totals", f"SELECT {COUNTS} FROM samples", ("samples",))
def summary_totals(v):
    return summary.totals(v.samples)


@case("summary_by_entity", "SELECT entity_type, count(*) AS sample_count FROM samples WHERE entity_type IS NOT NULL GROUP BY 1", ("samples",))
def summary_by_entity(v):
    return summary.by_entity_type(v.samples)


@case("summary_entity_members", "SELECT entity_type, sample_id FROM samples WHERE entity_type IS NOT NULL", ("samples",))
def summary_entity_members(v):
    return summary.entity_members(v.samples, "sample_id")


BY_CONFIG = """
SELECT s.config_id, s.total_samples, s.uploaded_samples, s.submitted_samples, s.entity_types,
       coalesce(c.name, 'Config ' || s.config_id) AS config_name, coalesce(c.entity_type, 'Unknown') AS config_entity_type
FROM (SELECT config_id, {counts}, count(DISTINCT entity_type) AS entity_types FROM samples {where} GROUP BY 1) s
LEFT JOIN (SELECT id, {name} AS name, entity_type FROM configs) c ON s.config_id = c.id"""


@case("summary_by_config", BY_CONFIG.format(counts=COUNTS, where=f"WHERE created_at >= {NOW} - INTERVAL 100000 HOUR", name="prefix"), ("samples", "configs"))
def summary_by_config(v):
    recent = lookup.samples_in(v.samples, "custom", ORDERS_AS_OF, "all", "all", hours_back=100_000, newest_first=False)
    return summary.by_config(recent, v.configs, "prefix")


@case("summary_daily", BY_CONFIG.format(counts=COUNTS, where=f"WHERE cast(created_at AS date) = {DAY}", name="name"), ("samples", "configs"))
def summary_daily(v):
    today = lookup.samples_in(v.samples, "today", ORDERS_AS_OF, "all", "all", newest_first=False)
    return summary.by_config(today, v.configs, "name")


@case("summary_config_types", "SELECT DISTINCT config_id, entity_type FROM samples", ("samples",))
def summary_config_types(v):
    return summary.config_entity_types(v.samples)


@case("summary_rollup", f"""
SELECT entity_type, config_id, cast(grouping(entity_type, config_id) AS bigint) AS level, {COUNTS}
FROM samples GROUP BY ROLLUP (entity_type, config_id)""", ("samples",))
def summary_rollup(v):
    return summary.rollup_counts(v.samples)


@case("state_summary", "SELECT config_id, coalesce(workflow_state, 'None') AS workflow_state, count(*) AS samples FROM samples GROUP BY 1, 2", ("samples",))
def state_summary(v):
    return summary.state_summary(v.samples)


PER_CONFIG = """
SELECT config_id, count(*) AS total_samples, count(submitted_at) AS done, count(*) FILTER (workflow_state = 'Failed') AS failed
FROM samples GROUP BY 1"""
STATUS = """CASE WHEN done > 0 AND failed > 0 THEN 'partial_success' WHEN done > 0 THEN 'success'
     WHEN failed > 0 THEN 'error' ELSE 'no_updates' END"""


def per_config(v):
    counts = v.samples.groupBy("config_id").agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count("submitted_at").alias("done"),
        F.count_if(col("workflow_state") == "Failed").alias("failed"),
    )
    return counts.withColumn("status", summary.derived_status(col("done"), col("failed")))


@case("derive_status", f"SELECT config_id, total_samples, done, failed, {STATUS} AS status FROM ({PER_CONFIG}) t", ("samples",))
def derive_status(v):
    return per_config(v)


@case("status_rollup", f"""
SELECT status, count(*) AS configs, cast(sum(total_samples) AS bigint) AS samples
FROM (SELECT *, {STATUS} AS status FROM ({PER_CONFIG}) t) u GROUP BY 1""", ("samples",))
def status_rollup(v):
    return summary.status_rollup(per_config(v))


@case("merged_states", "SELECT coalesce(workflow_state, 'None') AS workflow_state, count(*) AS samples FROM samples GROUP BY 1", ("samples",))
def merged_states(v):
    return summary.merged_states(summary.state_summary(v.samples))


HOURS = """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS events FROM events GROUP BY 1, 2, 3"""
SLIDES = """
SELECT h - INTERVAL 1 HOUR * k AS window_start, h - INTERVAL 1 HOUR * k + INTERVAL 4 HOUR AS window_end, event_type, count(*) AS events
FROM (SELECT date_trunc('hour', ts) AS h, event_type FROM events) e, range(4) r(k) GROUP BY 1, 2, 3"""


def windows(v, slide):
    from samplyard.streaming.windows import windowed_counts

    return windowed_counts(v.events, "ts", ["event_type"], "4 hours" if slide else "1 hour", slide)


@case("hourly_window", HOURS)
def hourly_window(v):
    return windows(v, None)


@case("sliding_window", SLIDES)
def sliding_window(v):
    return windows(v, "1 hour")


def streamed(v, build):
    """Run the stream over the events files to its end and read back the last state."""
    from samplyard.session import work_path
    from samplyard.streaming import windows as w

    events = v.events
    # The brackets make the name a pattern, which a stream resolves to a file and to a folder alike.
    stream = v.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(f"{v.sf_dir}/events.parque[t]")
    # Files come in any order, so the bound spans all the times there can be.
    counts = build(w.event_time(stream, "ts"), "ts", ["event_type"], "36500 days")
    out = work_path(v.spark, "stream")
    query = w.start_updates(counts, out, work_path(v.spark, "offsets"))
    query.awaitTermination()
    if w.dropped_rows(query):
        raise RuntimeError("the stream dropped late rows")
    keys = ["window_start", "window_end", "event_type"]
    utc = {k: utc_wall(col(k)) for k in keys[:2]}
    return w.latest_state(v.spark.read.parquet(out), keys).withColumns(utc)


@case("stream_hourly_window", HOURS)
def stream_hourly_window(v):
    from samplyard.streaming.windows import hourly_counts

    return streamed(v, hourly_counts)


@case("stream_sliding_window", SLIDES)
def stream_sliding_window(v):
    from samplyard.streaming.windows import sliding_counts

    return streamed(v, sliding_counts)
