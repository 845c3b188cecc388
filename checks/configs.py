"""Config tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import case
from checks.views import ORDERS_AS_OF
from samplyard.functions.columns import col
from samplyard.operators import lookup, search, tables, update
from samplyard.plans import ingest
from samplyard.schema import SchemaSpec

CONFIG = SchemaSpec.from_yaml("""
fields:
  id: {type: string, required: true, primary_key: true, system_value: true, configuration_identifier: true}
  name: {type: string, required: true, use_as_prefix: true}
  entity_type: {type: string, required: true}
  active: {type: boolean}
  transferred: {type: boolean}
  method_config: {type: json}
  prefix: {type: string, display_for_alerts: true}
  settings: {type: object}
  created_at: {type: datetime, system_value: true}
  updated_at: {type: datetime, system_value: true}
""")

NOW = f"timestamp '{ORDERS_AS_OF}'"


def stored(v):
    return v.configs.withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))


@case("active_configs", """
SELECT id, name, active, transferred FROM configs
WHERE active AND entity_type = 'building' AND (transferred IS NULL OR transferred = false)""", ("configs",))
def active_configs(v):
    return lookup.find_configs(v.configs, True, "building", True, newest_first=False).select("id", "name", "active", "transferred")


@case("existing_types", "SELECT DISTINCT entity_type FROM configs WHERE coalesce(entity_type, '') <> ''", ("configs",))
def existing_types(v):
    return lookup.existing_types(v.configs)


TABLE_NAMES = "SELECT DISTINCT CASE WHEN p_size < 10 THEN lower(p_type) || '_set' WHEN p_size < 30 THEN lower(p_type) || '_' || lower(p_brand) ELSE lower(p_name) END AS entity_type FROM part"


def table_names(v):
    name = (
        F.when(col("p_size") < 10, F.concat(F.lower("p_type"), F.lit("_set")))
        .when(col("p_size") < 30, F.concat(F.lower("p_type"), F.lit("_"), F.lower("p_brand")))
        .otherwise(F.lower("p_name"))
    )
    return v.part.select(name.alias("entity_type")).distinct()


@case("glob_tables", f"""
SELECT entity_type FROM ({TABLE_NAMES}) t WHERE entity_type LIKE 's%' AND entity_type NOT LIKE '%\\_set' ESCAPE '\\'""")
def glob_tables(v):
    return search.glob_tables(table_names(v), "s*")


@case("new_entity_types", f"""
SELECT entity_type FROM ({TABLE_NAMES} UNION SELECT lower(c_mktsegment) FROM customer) t
WHERE regexp_matches(entity_type, 'o.*e') AND entity_type NOT IN (SELECT entity_type FROM configs WHERE entity_type IS NOT NULL)""", ("configs",))
def new_entity_types(v):
    everything = table_names(v).unionByName(v.customer.select(F.lower("c_mktsegment").alias("entity_type")))
    return tables.new_entity_types(everything, v.configs, "o.*e")


@case("config_template", f"""
SELECT entity_type, true AS active, false AS transferred, 'lab-x' AS project, 'main' AS workspace, 'v2' AS version,
       36 AS id_length, 'sample_set' AS target
FROM ({TABLE_NAMES}) t""")
def config_template(v):
    built = tables.configs_from_template(
        table_names(v),
        template={"version": "v1", "project": "template", "method_config": {"entityType": "sample_set"}},
        defaults={"version": "v0", "workspace": "main"},
        computed={"project": "lab-x"},
        overrides={"version": "v2"},
        required=["id", "entity_type"],
    )
    return built.select(
        "entity_type", "active", "transferred", "project", "workspace", "version",
        F.length("id").alias("id_length"), F.get_json_object("method_config", "$.entityType").alias("target"),
    )


@case("process_configs", f"""
SELECT CASE WHEN c_nationkey < 10 THEN cast(c_custkey AS string) ELSE 'generated' END AS id, c_name AS name,
       c_mktsegment AS segment, cast(c_nationkey AS string) AS nation,
       CASE WHEN c_acctbal > 0 THEN timestamp '2024-01-01 00:00:00' ELSE {NOW} END AS created_at
FROM customer""")
def process_configs(v):
    given = v.customer.select(
        F.when(col("c_nationkey") < 10, col("c_custkey").cast("string")).alias("id"),
        col("c_name").alias("name"),
        F.struct(col("c_mktsegment").alias("segment"), col("c_nationkey").alias("nation")).alias("settings"),
        F.when(col("c_acctbal") > 0, F.lit("2024-01-01").cast("timestamp_ntz")).alias("created_at"),
    )
    done = ingest.process_configs(given, CONFIG, ORDERS_AS_OF)
    return done.select(
        F.when(F.length("id") == 36, "generated").otherwise(col("id")).alias("id"),
        "name",
        F.get_json_object("settings", "$.segment").alias("segment"),
        F.get_json_object("settings", "$.nation").alias("nation"),
        "created_at",
    )


@case("update_config", f"""
SELECT id, CASE WHEN id = '17' THEN 'renamed' ELSE name END AS name,
       CASE WHEN id = '17' THEN 'fish' ELSE json_extract_string(method_config, '$.entityType') END AS target,
       CASE WHEN id = '17' THEN {NOW} END AS updated_at FROM configs""", ("configs",))
def update_config(v):
    done = update.update_config(
        stored(v), "17", {"id": "ignored", "name": "renamed", "method_config": {"entityType": "fish"}}, CONFIG, ORDERS_AS_OF
    )
    return done.select("id", "name", F.get_json_object("method_config", "$.entityType").alias("target"), "updated_at")


@case("mark_transferred", f"""
SELECT id, CASE WHEN entity_type = 'building' THEN true ELSE transferred END AS transferred,
       CASE WHEN entity_type = 'building' THEN {NOW} END AS updated_at FROM configs""", ("configs",))
def mark_transferred(v):
    done = update.mark_transferred(stored(v), v.configs.filter("entity_type = 'building'"), ORDERS_AS_OF)
    return done.select("id", "transferred", "updated_at")


@case("deactivate", f"""
SELECT id, CASE WHEN entity_type = 'furniture' AND prefix = 'lab_3' THEN false ELSE active END AS active,
       CASE WHEN active AND entity_type = 'furniture' AND prefix = 'lab_3' THEN {NOW} END AS updated_at FROM configs""", ("configs",))
def deactivate(v):
    done = update.deactivate(stored(v), {"entity_type": "furniture", "prefix": "lab_3"}, ORDERS_AS_OF)
    return done.select("id", "active", "updated_at")


@case("delete_by_id", "SELECT id, name FROM configs WHERE active", ("configs",))
def delete_by_id(v):
    return update.delete_ids(v.configs, v.configs.filter("NOT active")).select("id", "name")
