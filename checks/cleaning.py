"""Cleaning pipeline and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import case
from checks.views import ORDERS_AS_OF
from samplyard.functions import dates, jsontext, names, paths
from samplyard.functions.columns import col
from samplyard.functions.types import coerce
from samplyard.operators import clean
from samplyard.plans import ingest
from samplyard.schema import SchemaSpec

INTAKE = SchemaSpec.from_yaml("""
fields:
  id: {type: string, required: true, primary_key: true, system_value: true}
  sample_id: {type: string, required: true, sample_identifier: true}
  config_id: {type: string, inherit_from_config: id, configuration_identifier: true, system_value: true}
  entity_type: {type: string, inherit_from_config: entity_type, system_value: true}
  priority: {type: string, required: true, accepted_pattern: "[1-5]-[A-Z]+$"}
  total: {type: float, column_mappings: [order_total, src_total]}
  units: {type: integer, column_mappings: src_units}
  rush: {type: boolean, column_mappings: [src_rush]}
  collected: {type: string, date_format: YYYY-MM-DD, column_mappings: [src_collected]}
  received_on: {type: date, column_mappings: [src_collected]}
  read1: {type: string, sequence_file: true}
  read2: {type: string, sequence_file: true}
  lab_note: {type: string}
  created_at: {type: datetime, required: true, system_value: true}
""")

PARSED = """coalesce(try_strptime(src_collected, '%Y-%m-%d'), try_strptime(src_collected, '%m/%d/%Y'),
    try_strptime(src_collected, '%d/%m/%Y'), try_strptime(src_collected, '%Y%m%d'),
    try_strptime(src_collected, '%Y-%m-%dT%H:%M:%SZ'))"""
HAS_FILE = "(coalesce(read1, '') <> '' OR coalesce(read2, '') <> '')"
PATTERN = "(priority IS NULL OR regexp_matches(priority, '^([1-5]-[A-Z]+$)'))"
VALID_DATE = f"(src_collected IS NULL OR {PARSED} IS NOT NULL)"
TOTAL = "try_cast(src_total AS double)"
UNITS = "CASE WHEN try_cast(src_units AS double) = floor(try_cast(src_units AS double)) THEN cast(try_cast(src_units AS double) AS bigint) END"
RUSH = "CASE WHEN src_rush IN ('true','True','TRUE','1') THEN true WHEN src_rush IN ('false','False','FALSE','0') THEN false END"

KNOWN = "SELECT sample_id, config_id FROM samples WHERE uploaded_at IS NOT NULL AND entity_type = '2-HIGH'"


def known_samples(v):
    return v.samples.filter("uploaded_at IS NOT NULL AND entity_type = '2-HIGH'")


CLEAN_COLUMNS = [n for n in INTAKE.names if n != "id"]
CLEAN_SQL = f"""
SELECT r.entity_id AS sample_id, c.id AS config_id, c.entity_type AS entity_type, r.priority AS priority,
       {TOTAL} AS total, {UNITS} AS units, {RUSH} AS rush, strftime({PARSED}, '%Y-%m-%d') AS collected,
       cast({PARSED} AS date) AS received_on, r.read1 AS read1, r.read2 AS read2,
       cast(NULL AS string) AS lab_note, timestamp '{ORDERS_AS_OF}' AS created_at
FROM raw_orders r LEFT JOIN configs c ON r.config = c.id
WHERE {HAS_FILE} AND {PATTERN} AND {VALID_DATE}
"""


@case("process_samples", CLEAN_SQL + f"AND NOT EXISTS (SELECT 1 FROM ({KNOWN}) k WHERE k.sample_id = r.entity_id)", ("raw_orders", "configs", "samples"))
def process_samples(v):
    done = ingest.process_samples(
        v.raw, INTAKE, known=known_samples(v), configs=v.configs, config_column="config",
        entity_type="order", as_of=ORDERS_AS_OF,
    )
    return done.select(*CLEAN_COLUMNS)


@case("load_counts", f"""
SELECT count(*) FILTER (ok) AS loaded, count(*) FILTER (NOT ok) AS filtered FROM (
  SELECT {HAS_FILE} AND {PATTERN} AND {VALID_DATE}
         AND NOT EXISTS (SELECT 1 FROM ({KNOWN}) k WHERE k.sample_id = r.entity_id) AS ok
  FROM raw_orders r) t""", ("raw_orders", "samples"))
def load_counts(v):
    screened = ingest.screen_samples(v.raw, INTAKE, known_samples(v), v.configs, "config", "order")
    return screened.agg(
        F.count_if(col("reason").isNull()).alias("loaded"), F.count_if(col("reason").isNotNull()).alias("filtered")
    )


@case("entity_rename", "SELECT entity_id AS sample_id, priority, read1 FROM raw_orders", ("raw_orders",))
def entity_rename(v):
    return clean.rename_entity_id(v.raw, INTAKE, "order").select("sample_id", "priority", "read1")


@case("column_mapping", """
SELECT config, priority, read1, read2, extra, src_total AS total, src_units AS units, src_rush AS rush,
       src_collected AS collected, src_collected AS received_on FROM raw_orders""", ("raw_orders",))
def column_mapping(v):
    return clean.map_columns(v.raw, INTAKE).drop("entity:order_id")


@case("complete_columns", """
SELECT priority, cast(NULL AS string) AS sample_id, cast(NULL AS double) AS total, cast(NULL AS bigint) AS units,
       cast(NULL AS boolean) AS rush, cast(NULL AS date) AS received_on FROM raw_orders""", ("raw_orders",))
def complete_columns(v):
    return clean.complete_columns(v.raw, INTAKE).select("priority", "sample_id", "total", "units", "rush", "received_on")


@case("prune_columns", "SELECT priority, read1, read2 FROM raw_orders", ("raw_orders",))
def prune_columns(v):
    return clean.prune_columns(v.raw, INTAKE)


@case("config_inherit", """
SELECT r.entity_id AS sample_id, c.id AS config_id, c.entity_type AS entity_type
FROM raw_orders r LEFT JOIN configs c ON r.config = c.id""", ("raw_orders", "configs"))
def config_inherit(v):
    joined = clean.attach_config(v.raw, v.configs, "config", list(INTAKE.inherited.values()))
    return clean.shape_columns(joined, INTAKE, "order").select("sample_id", "config_id", "entity_type")


@case("system_values", f"""
SELECT count(*) AS samples, count(*) AS ids, 36 AS id_length, timestamp '{ORDERS_AS_OF}' AS created_at FROM orders""")
def system_values(v):
    stamped = clean.add_system_values(v.samples, INTAKE, ORDERS_AS_OF)
    per_id = stamped.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("created_at").alias("created_at"))
    return per_id.agg(
        F.sum("n").alias("samples"),
        F.count(F.lit(1)).alias("ids"),
        F.max(F.length("id")).alias("id_length"),
        F.max("created_at").alias("created_at"),
    )


@case("drop_system", "SELECT sample_id, uploaded_at, submitted_at, updated_at, upload_source, submission_id, workflow_id, workflow_state FROM samples", ("samples",))
def drop_system(v):
    return clean.drop_system_columns(v.samples, INTAKE)


@case("transform_hook", f"""
SELECT entity_id AS sample_id, priority, {TOTAL} AS total FROM raw_orders
WHERE {HAS_FILE} AND {PATTERN} AND {VALID_DATE} AND src_total <> 'n/a'""", ("raw_orders",))
def transform_hook(v):
    cleanup = lambda df: df.filter(col("src_total") != "n/a")
    done = ingest.process_samples(v.raw, INTAKE, entity_type="order", transform=cleanup, as_of=ORDERS_AS_OF)
    return done.select("sample_id", "priority", "total")


@case("has_sequence_file", f"SELECT entity_id, read1, read2 FROM raw_orders WHERE {HAS_FILE}", ("raw_orders",))
def has_sequence_file(v):
    return v.raw_orders.filter(clean.has_sequence_file(INTAKE)).select("entity_id", "read1", "read2")


@case("pattern_filter", f"SELECT entity_id, priority FROM raw_orders WHERE {PATTERN}", ("raw_orders",))
def pattern_filter(v):
    raw = v.raw_orders
    return raw.filter(clean.matches_patterns(INTAKE, raw.columns)).select("entity_id", "priority")


@case("date_validity", f"SELECT entity_id, src_collected AS collected FROM raw_orders WHERE {VALID_DATE}", ("raw_orders",))
def date_validity(v):
    rows = v.raw_orders.select("entity_id", col("src_collected").alias("collected"))
    return rows.filter(clean.has_valid_dates(INTAKE, rows.columns))


@case("required_check", """
SELECT 'id' AS field, count(*) AS missing FROM raw_orders UNION ALL
SELECT 'sample_id', count(*) FILTER (entity_id IS NULL) FROM raw_orders UNION ALL
SELECT 'priority', count(*) FILTER (priority IS NULL) FROM raw_orders UNION ALL
SELECT 'created_at', count(*) FROM raw_orders""", ("raw_orders",))
def required_check(v):
    return clean.missing_required(clean.rename_entity_id(v.raw, INTAKE, "order"), INTAKE)


@case("anti_existing", f"""
SELECT entity_id AS sample_id, config AS config_id FROM raw_orders r
WHERE NOT EXISTS (SELECT 1 FROM ({KNOWN}) k WHERE k.sample_id = r.entity_id)""", ("raw_orders", "samples"))
def anti_existing(v):
    batch = v.raw_orders.select(col("entity_id").alias("sample_id"), col("config").alias("config_id"))
    return clean.drop_known(batch, known_samples(v), "sample_id")


@case("anti_existing_by_config", f"""
SELECT entity_id AS sample_id, config_id FROM (
  SELECT entity_id, CASE WHEN priority = '2-HIGH' AND read1 IS NULL THEN 'other' ELSE config END AS config_id FROM raw_orders) r
WHERE NOT EXISTS (SELECT 1 FROM (SELECT sample_id, config_id FROM samples WHERE uploaded_at IS NULL) k
                  WHERE k.sample_id = r.entity_id AND k.config_id = r.config_id)""", ("raw_orders", "samples"))
def anti_existing_by_config(v):
    config = F.when((col("priority") == "2-HIGH") & col("read1").isNull(), "other").otherwise(col("config"))
    batch = v.raw_orders.select(col("entity_id").alias("sample_id"), config.alias("config_id"))
    return clean.drop_known(batch, v.samples.filter("uploaded_at IS NULL"), "sample_id", "config_id")


@case("coerce_types", f"""
SELECT entity_id, {TOTAL} AS total, {UNITS} AS units, {RUSH} AS rush, cast({PARSED} AS date) AS received_on,
       {PARSED} AS received_at FROM raw_orders""", ("raw_orders",))
def coerce_types(v):
    return v.raw_orders.select(
        "entity_id",
        coerce(col("src_total"), "float").alias("total"),
        coerce(col("src_units"), "integer").alias("units"),
        coerce(col("src_rush"), "boolean").alias("rush"),
        coerce(col("src_collected"), "date").alias("received_on"),
        coerce(col("src_collected"), "datetime").alias("received_at"),
    )


@case("parse_dates", f"SELECT entity_id, src_collected, {PARSED} AS parsed FROM raw_orders", ("raw_orders",))
def parse_dates(v):
    return v.raw_orders.select("entity_id", "src_collected", dates.parse_wall(col("src_collected")).alias("parsed"))


@case("format_dates", f"""
SELECT entity_id, strftime({PARSED}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN src_collected LIKE '%Z' THEN '+00:00' ELSE '' END AS iso,
       strftime({PARSED}, '%m/%d/%Y') AS us, strftime({PARSED}, '%d.%m.%y %H:%M') AS custom,
       strftime({PARSED}, '%Y/%m/%d') AS ymd FROM raw_orders""", ("raw_orders",))
def format_dates(v):
    text = col("src_collected")
    return v.raw_orders.select(
        "entity_id",
        dates.format_date(text, "ISO 8601").alias("iso"),
        dates.format_date(text, "MM/DD/YYYY").alias("us"),
        dates.format_date(text, "%d.%m.%y %H:%M").alias("custom"),
        dates.format_date(text, "YYYY/MM/DD").alias("ymd"),
    )


@case("json_serialise", """
SELECT event_id, event_type AS kind, round(value, 2) AS value, cast(user_id AS string) AS user_text FROM events""")
def json_serialise(v):
    nested = v.events.select(
        "event_id", F.struct(F.col("event_type").alias("kind"), F.round("value", 2).alias("value"), F.col("user_id").alias("user")).alias("doc")
    )
    text = nested.select("event_id", jsontext.serialise(col("doc"), nested.schema["doc"].dataType).alias("doc"))
    return text.select(
        "event_id",
        F.get_json_object("doc", "$.kind").alias("kind"),
        F.get_json_object("doc", "$.value").cast("double").alias("value"),
        F.get_json_object("doc", "$.user").alias("user_text"),
    )


@case("json_extract", """
SELECT id, regexp_replace(json_extract_string(method_config, '$.entityType'), '_set$', '') AS target,
       json_extract_string(method_config, '$.rootNode.key') AS root_key FROM configs""", ("configs",))
def json_extract(v):
    return v.configs.select(
        "id",
        jsontext.target_entity(col("method_config")).alias("target"),
        F.get_json_object("method_config", "$.rootNode.key").alias("root_key"),
    )


OBJECT = "CASE WHEN url LIKE 'https%' THEN 'gs://' || substr(url, 9) ELSE url END"


def page_paths(v):
    path = F.when(col("url").startswith("https"), F.concat(F.lit("gs://"), F.expr("substr(url, 9)"))).otherwise(col("url"))
    return v.pages.select("page_id", path.alias("path"))


@case("path_split", f"""
SELECT page_id, CASE WHEN path LIKE 'gs://%' THEN split_part(substr(path, 6), '/', 1) END AS bucket,
       CASE WHEN path LIKE 'gs://%' THEN substr(path, 7 + length(split_part(substr(path, 6), '/', 1))) END AS object_key
FROM (SELECT page_id, {OBJECT} AS path FROM pages) p""")
def path_split(v):
    return page_paths(v).select("page_id", paths.bucket_of(col("path")).alias("bucket"), paths.key_of(col("path")).alias("object_key"))


@case("path_rewrite", f"""
SELECT page_id,
       CASE WHEN path LIKE 'gs://%' AND split_part(substr(path, 6), '/', 1) <> 'spam-farm.example.org'
            THEN 'gs://spam-farm.example.org/in/' || substr(path, 7 + length(split_part(substr(path, 6), '/', 1))) ELSE path END AS kept,
       CASE WHEN path LIKE 'gs://%' AND split_part(substr(path, 6), '/', 1) <> 'spam-farm.example.org'
            THEN 'gs://spam-farm.example.org/' || string_split(path, '/')[-1] ELSE path END AS flat
FROM (SELECT page_id, {OBJECT} AS path FROM pages) p""")
def path_rewrite(v):
    return page_paths(v).select(
        "page_id",
        paths.destination_path(col("path"), "gs://spam-farm.example.org/in", True).alias("kept"),
        paths.destination_path(col("path"), "spam-farm.example.org").alias("flat"),
    )


@case("set_name", """
SELECT id, prefix || '_20240130_155959' AS set_name FROM configs""", ("configs",))
def set_name(v):
    return v.configs.select(
        "id", names.set_name(col("prefix"), clean.moment("2024-01-30 23:59:59"), "America/Los_Angeles").alias("set_name")
    )


@case("name_helpers", r"""
SELECT page_id, regexp_replace(last_part, '(.)\.[^.]*$', '\1') AS stem, regexp_replace(url, '[^A-Za-z0-9_.\-]+', '_', 'g') AS safe,
       regexp_replace(lang || '_set', '_set$', '') AS bare
FROM (SELECT page_id, url, string_split(url, '/')[-1] AS last_part, split_part(url, '/', 4) AS lang FROM pages) p""")
def name_helpers(v):
    return v.pages.select(
        "page_id",
        names.file_stem(col("url")).alias("stem"),
        names.safe_name(col("url")).alias("safe"),
        names.without_suffix(F.concat(F.split_part("url", F.lit("/"), F.lit(4)), F.lit("_set")), "_set").alias("bare"),
    )


LANED = "'D' || cast(l_orderkey AS string) || CASE l_returnflag WHEN 'A' THEN '_L00' WHEN 'R' THEN '-l' ELSE '_L0' END || cast(l_linenumber AS string) || CASE l_linestatus WHEN 'O' THEN '_R1_001.fastq.gz' ELSE '' END"


@case("strip_lane", rf"""
SELECT DISTINCT name, regexp_replace(name, '(?i)[_-]L\d{{1,3}}(_R[12].*|)$', '\1') AS bare
FROM (SELECT {LANED} AS name FROM lineitem) t""")
def strip_lane(v):
    rows = v.lineitem.select(F.expr(LANED).alias("name")).distinct()
    return rows.select("name", names.strip_lane(col("name")).alias("bare"))


@case("read_side", r"""
SELECT file_id, CASE WHEN regexp_matches(file_name, '(?i)[_-]R1.*\.fastq\.gz$') THEN 'R1'
                     WHEN regexp_matches(file_name, '(?i)[_-]R2.*\.fastq\.gz$') THEN 'R2' END AS read FROM files""", ("files",))
def read_side(v):
    return v.files.select("file_id", names.read_side(col("file_name")).alias("read"))
