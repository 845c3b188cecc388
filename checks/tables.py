"""Entity tables: merging, promoting, publishing, searching, reading."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import case
from samplyard.functions.columns import col
from samplyard.operators import filejobs, search, summary, tables, terms, workflows
from samplyard.session import work_path
from samplyard.sources import delimited, entities

# Three overlapping tables cut from orders: primary has the open and pending orders, secondary the
# urgent, high and low priorities (plus keys of its own), master the urgent ones of before 1999.
PRIMARY = "SELECT 'S' || cast(o_orderkey AS string) AS pk, o_custkey AS attribute1, o_orderstatus AS attribute2 FROM orders WHERE o_orderstatus IN ('O', 'P')"
SECONDARY = """
SELECT CASE WHEN o_totalprice > 2000 THEN 'S' || cast(o_orderkey AS string) END AS sk, o_orderpriority AS attribute2,
       o_totalprice AS attribute3 FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')"""
MASTER = "SELECT 'S' || cast(o_orderkey AS string) AS mk FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate < timestamp '1999-01-01 00:00:00'"
P_KEY, S_KEY, M_KEY = "entity:sample_id", "entity:sample_metadata_id", "entity:sample_master_id"


def primary(v):
    return v.spark.sql(PRIMARY.replace("FROM orders", "FROM {orders}"), orders=v.orders).withColumnRenamed("pk", P_KEY)


def secondary(v):
    return v.spark.sql(SECONDARY.replace("FROM orders", "FROM {orders}"), orders=v.orders).withColumnRenamed("sk", S_KEY)


def master(v):
    return v.spark.sql(MASTER.replace("FROM orders", "FROM {orders}"), orders=v.orders).withColumnRenamed("mk", M_KEY)


CUT = f"p AS ({PRIMARY}), s AS ({SECONDARY}), m AS ({MASTER})"


@case("common_ids", f"WITH {CUT} SELECT pk AS id FROM p INTERSECT SELECT sk FROM s WHERE sk IS NOT NULL")
def common_ids(v):
    return tables.common_ids(primary(v), secondary(v), P_KEY, S_KEY)


@case("diff_ids", f"WITH {CUT} SELECT sk AS id FROM s WHERE sk IS NOT NULL EXCEPT SELECT pk FROM p")
def diff_ids(v):
    return tables.new_ids(secondary(v), primary(v), S_KEY, P_KEY)


@case("new_ids", f"WITH {CUT} SELECT DISTINCT sk AS id FROM s WHERE sk IS NOT NULL AND sk NOT IN (SELECT mk FROM m)")
def new_ids(v):
    return tables.new_ids(secondary(v), master(v), S_KEY, M_KEY)


@case("promote_new", f"""
WITH {CUT} SELECT sk AS master_id, attribute2, attribute3 FROM s
WHERE sk IS NOT NULL AND sk NOT IN (SELECT mk FROM m) AND attribute3 < 300000""")
def promote_new(v):
    moved = tables.promote(secondary(v), master(v), S_KEY, M_KEY, lambda df: df.filter("attribute3 < 300000"))
    return moved.withColumnRenamed(M_KEY, "master_id")


@case("merge_tables", f"""
WITH {CUT} SELECT pk AS sample_id, attribute1, p.attribute2 AS attribute2_x, s.attribute2 AS attribute2_y, attribute3
FROM p JOIN s ON p.pk = s.sk""")
def merge_tables(v):
    return tables.merge_tables(primary(v), secondary(v), P_KEY, S_KEY).withColumnRenamed(P_KEY, "sample_id")


@case("merge_new_only", f"""
WITH {CUT} SELECT pk AS master_id, attribute1, p.attribute2 AS attribute2_x, s.attribute2 AS attribute2_y, attribute3
FROM p JOIN s ON p.pk = s.sk WHERE pk NOT IN (SELECT mk FROM m)""")
def merge_new_only(v):
    merged = tables.merge_into_master(primary(v), secondary(v), master(v), P_KEY, S_KEY, M_KEY)
    return merged.withColumnRenamed(M_KEY, "master_id")


@case("merge_include_fields", f"WITH {CUT} SELECT pk AS sample_id, attribute1, attribute3 FROM p JOIN s ON p.pk = s.sk")
def merge_include_fields(v):
    merged = tables.merge_tables(primary(v), secondary(v), P_KEY, S_KEY, include=["attribute1", "attribute3", "none"], exclude=["attribute1"])
    return merged.withColumnRenamed(P_KEY, "sample_id")


@case("publish_layout", "SELECT sample_id AS \"entity:fish_id\", config_id, upload_source FROM samples", ("samples",))
def publish_layout(v):
    return tables.publish_layout(v.samples.select("config_id", "sample_id", "upload_source"), "fish_id", "sample_id")


@case("set_membership", "SELECT 'set_1' AS \"membership:fish_set_id\", sample_id AS fish FROM samples", ("samples",))
def set_membership(v):
    return tables.set_membership(v.samples, "fish", "set_1", "sample_id")


@case("sets_by_source", "SELECT config_id, upload_source AS set_name, sample_id AS entity FROM samples WHERE upload_source IS NOT NULL", ("samples",))
def sets_by_source(v):
    return tables.sets_by_source(v.samples, "sample_id")


@case("set_sizes", "SELECT config_id, upload_source AS set_name, count(*) AS members FROM samples WHERE upload_source IS NOT NULL GROUP BY 1, 2", ("samples",))
def set_sizes(v):
    return tables.set_sizes(tables.sets_by_source(v.samples, "sample_id"))


@case("entity_id_map", "SELECT sample_id, id FROM samples", ("samples",))
def entity_id_map(v):
    return tables.entity_id_map(v.samples, "sample_id")


# ---- search --------------------------------------------------------------------------------

FOUND = "doc_id, lang, source, n_chars"
DOC = FOUND.split(", ")


@case("row_search", f"""
SELECT {FOUND} FROM documents WHERE regexp_matches(lower(text), 'the\\s+of') OR regexp_matches(lower(source), 'src1')
   OR regexp_matches(lower(text), 'src1') OR regexp_matches(lower(source), 'the\\s+of')""")
def row_search(v):
    return search.row_search(v.documents, ["THE\\s+of", "src1"], ["text", "source", "nothing"]).select(*DOC)


@case("row_search_exact", f"SELECT {FOUND} FROM documents WHERE lang = 'en' OR source = 'src7' OR lang = 'src7' OR source = 'en'")
def row_search_exact(v):
    return search.row_search(v.documents, ["en", "src7"], ["lang", "source"], exact=True).select(*DOC)


@case("row_search_exclude", "SELECT DISTINCT p_name, p_brand, p_type FROM part WHERE NOT (lower(p_name) LIKE '%ring%' OR lower(p_type) LIKE '%ring%' OR lower(p_brand) LIKE '%ring%') OR NOT (lower(p_type) LIKE '%promo%' OR lower(p_name) LIKE '%promo%' OR lower(p_brand) LIKE '%promo%')")
def row_search_exclude(v):
    return search.row_search(v.part.select("p_name", "p_brand", "p_type"), ["ring", "PROMO"], exclude=True)


@case("row_search_limit", """
SELECT * FROM (SELECT p_partkey, p_name, p_type FROM part WHERE p_name LIKE '%ring%' ORDER BY p_partkey LIMIT 40)
UNION SELECT * FROM (SELECT p_partkey, p_name, p_type FROM part WHERE lower(p_type) LIKE '%eco%' ORDER BY p_partkey LIMIT 40)""")
def row_search_limit(v):
    rows = v.part.select("p_partkey", "p_name", "p_type")
    return search.row_search(rows, ["ring", "eco"], ["p_name", "p_type"], max_rows=40, order=["p_partkey"])


FOUND_AT_RANDOM = """
SELECT * FROM (SELECT p_partkey, p_name, p_type FROM part WHERE lower(p_name) LIKE '%{term}%' OR lower(p_type) LIKE '%{term}%'
               ORDER BY md5('42|' || cast(p_partkey AS string)), p_partkey LIMIT 40)"""


@case("row_search_random", FOUND_AT_RANDOM.format(term="ring") + " UNION " + FOUND_AT_RANDOM.format(term="eco"))
def row_search_random(v):
    rows = v.part.select("p_partkey", "p_name", "p_type")
    return search.row_search(rows, ["ring", "eco"], max_rows=40, randomize=True, order=["p_partkey"])


SYLLABLES = ["tion", "eau", "ing", "the", "oux", "ent", "ment", "ère", "ich", "und", "que", "con", "los", "and"]
TERMS = [a + b for a in SYLLABLES for b in SYLLABLES] + ["the\\s+of", "^the.*ing\\.$", "(qu|ch)e[aeiou]{3}x?", "SRC[0-9]7"]
EACH_TERM = "(SELECT unnest([" + ", ".join(f"'{term}'" for term in TERMS) + "]) AS term)"


@case("search_terms", f"""
SELECT term, doc_id FROM documents, {EACH_TERM}
WHERE regexp_matches(lower(text), lower(term)) OR regexp_matches(lower(source), lower(term))""")
def search_terms(v):
    return terms.term_hits(v.documents, TERMS, ["text", "source"], ["doc_id"])


@case("search_terms_limit", f"""
SELECT DISTINCT doc_id, lang, source FROM (
  SELECT d.*, row_number() OVER (PARTITION BY term ORDER BY n_chars, doc_id) AS place
  FROM documents d, {EACH_TERM} WHERE regexp_matches(lower(text), lower(term)))
WHERE place <= 3""")
def search_terms_limit(v):
    return search.row_search(v.documents, TERMS, ["text"], max_rows=3, order=["n_chars", "doc_id"]).select("doc_id", "lang", "source")


@case("select_ids", "SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def select_ids(v):
    return search.select_ids(v.documents, v.labels, "doc_id").select("doc_id", "lang", "source")


@case("missing_ids", "SELECT user_id FROM (SELECT DISTINCT user_id FROM events) e WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def missing_ids(v):
    present = v.customer.filter("c_acctbal > 0").select(col("c_custkey").alias("user_id"))
    return search.missing_ids(present, v.events, "user_id")


@case("extract_columns", "SELECT doc_id, lang, source FROM documents")
def extract_columns(v):
    return search.extract_columns(v.documents, ["source", "lang", "absent"], "doc_id")


@case("control_filter", """
SELECT p_partkey, p_name, p_brand FROM part
WHERE NOT regexp_matches(p_name, 'ring|old|red') AND (p_brand IS NULL OR p_brand <> 'Brand#4')""")
def control_filter(v):
    return search.drop_controls(v.part.select("p_partkey", "p_name", "p_brand"), "p_name", "ring|old|red", "p_brand", "Brand#4")


# ---- reading -------------------------------------------------------------------------------

CELL = "CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_orderpriority END"


def staged_tsv(v):
    """Orders written as a tab-separated entity table, with texts that stand for missing values."""
    out = work_path(v.spark, "tsv")
    cell = F.when(col("o_orderpriority") == "5-LOW", "NA").when(col("o_orderpriority") == "2-HIGH", "null").otherwise(col("o_orderpriority"))
    rows = v.orders.select(
        col("o_orderkey").cast("string").alias("entity:order_id"), cell.alias("priority"),
        F.concat(F.lit('say "'), "o_orderstatus", F.lit('"')).alias("quoted"), F.col("o_custkey").alias("customer"),
    )
    delimited.write_entity_table(rows, out)
    return out


@case("scan_entity_tsv", f"""
SELECT cast(o_orderkey AS string) AS "entity:order_id", {CELL} AS priority, 'say "' || o_orderstatus || '"' AS quoted,
       cast(o_custkey AS string) AS customer FROM orders""")
def scan_entity_tsv(v):
    return delimited.read_entity_table(v.spark, staged_tsv(v))


@case("scan_pruned", "SELECT cast(o_orderkey AS string) AS \"entity:order_id\", cast(o_custkey AS string) AS customer FROM orders")
def scan_pruned(v):
    return delimited.read_entity_table(v.spark, staged_tsv(v), columns=["customer", "absent"])


@case("flatten_entity_pages", """
SELECT 'P' || cast(p_partkey AS string) AS "entity:part_id", p_name, p_brand,
       CASE WHEN p_size <= 40 THEN cast(p_size AS string) END AS p_size, cast(NULL AS string) AS p_color FROM part""")
def flatten_entity_pages(v):
    return entities.flatten_pages(entities.parse_pages(v.entity_pages), "part_id", ["part_id", "p_name", "p_brand", "p_size", "p_color"])


@case("flatten_entity_pages_pruned", "SELECT 'P' || cast(p_partkey AS string) AS \"entity:part_id\", p_brand FROM part")
def flatten_entity_pages_pruned(v):
    return entities.flatten_pages(entities.parse_pages(v.entity_pages), "part_id", ["p_name", "p_brand"], ["p_brand"])


# ---- paths ---------------------------------------------------------------------------------

PATHS = """
SELECT page_id, CASE WHEN url LIKE 'https%' THEN 'gs://' || substr(url, 9) ELSE url END AS read1,
       'gs://mirror/' || split_part(url, '/', 3) || '/' || cast(page_id AS string) AS read2 FROM pages"""
PARTS = "split_part(substr(uri, 6), '/', 1)"


def page_files(v):
    return v.pages.select(
        "page_id",
        F.when(col("url").startswith("https"), F.concat(F.lit("gs://"), F.expr("substr(url, 9)"))).otherwise(col("url")).alias("read1"),
        F.concat(F.lit("gs://mirror/"), F.split_part("url", F.lit("/"), F.lit(3)), F.lit("/"), "page_id").alias("read2"),
    )


@case("uri_inventory", f"""
SELECT DISTINCT "column", {PARTS} AS bucket, substr(uri, 7 + length({PARTS})) AS key
FROM (SELECT 'read1' AS "column", read1 AS uri FROM ({PATHS}) a UNION ALL SELECT 'read2', read2 FROM ({PATHS}) b) t
WHERE uri LIKE 'gs://%'""")
def uri_inventory(v):
    return summary.uri_inventory(page_files(v), ["read1", "read2"])


@case("copy_manifest", f"""
SELECT source, destination, count(*) OVER (PARTITION BY destination) > 1 AS collides FROM (
  SELECT DISTINCT uri AS source, 'gs://vault/' || string_split(uri, '/')[-1] AS destination
  FROM (SELECT read1 AS uri FROM ({PATHS}) a UNION ALL SELECT read2 FROM ({PATHS}) b) t WHERE uri LIKE 'gs://%') d""")
def copy_manifest(v):
    return filejobs.copy_manifest(page_files(v), ["read1", "read2", "absent"], "gs://vault")


@case("rewrite_paths", f"""
SELECT page_id, CASE WHEN read1 LIKE 'gs://%' THEN 'gs://vault/in/' || substr(read1, 7 + length(split_part(substr(read1, 6), '/', 1))) ELSE read1 END AS read1,
       'gs://vault/in/' || substr(read2, 13) AS read2 FROM ({PATHS}) p""")
def rewrite_paths(v):
    return filejobs.rewrite_paths(page_files(v), ["read1", "read2"], "gs://vault/in", True)


@case("backfill_column", """
SELECT u.id, u.sample_id, coalesce(u.lab, e.lab) AS lab FROM user_samples u
LEFT JOIN (SELECT 'U' || cast(user_id AS string) AS sample_id, arg_min(event_type, event_id) AS lab FROM events GROUP BY 1) e
ON u.sample_id = e.sample_id""", ("user_samples",))
def backfill_column(v):
    other = v.events.select(F.concat(F.lit("U"), "user_id").alias("name"), col("event_type").alias("lab"), "event_id")
    done = workflows.backfill_column(v.user_samples, other, "lab", "sample_id", "name", "event_id")
    return done.select("id", "sample_id", "lab")
