"""Landed files, some of them damaged, uploads and exports: written from the tables, then read."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.configs import CONFIG, NOW
from checks.registry import case
from checks.views import ORDERS_AS_OF
from samplyard.functions.columns import col
from samplyard.operators import lookup
from samplyard.session import work_path
from samplyard.sources import catalog, delimited, pages, screening, wholefiles

PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_size"]
# Every tenth part has a line that lacks a cell, one with a cell too many, and one without an id.
LINE = """
    concat_ws(chr(9), CASE WHEN p_partkey % 10 = 9 THEN '' ELSE cast(p_partkey AS string) END, p_name,
              CASE WHEN p_partkey % 10 <> 3 THEN p_brand END, cast(p_size AS string),
              CASE WHEN p_partkey % 10 = 7 THEN 'one more' END)"""
REASON = """
    CASE p_partkey % 10 WHEN 3 THEN 'too few cells' WHEN 7 THEN 'too many cells' WHEN 9 THEN 'no id' END"""


def part_lines(v):
    source = work_path(v.spark, "landed")
    v.part.select(F.expr(LINE).alias("line")).repartition(4).write.text(source)
    return screening.load_table(v.spark, source, work_path(v.spark, "parts"), PART_COLUMNS)


@case("screened_table", f"""
SELECT CASE WHEN reason IS NULL THEN cast(p_partkey AS string) END AS p_partkey, p_name, p_brand, p_size, reason, line
FROM (SELECT p_partkey, CASE WHEN p_partkey % 10 NOT IN (3, 7) THEN p_name END AS p_name,
             CASE WHEN p_partkey % 10 NOT IN (3, 7) THEN p_brand END AS p_brand,
             CASE WHEN p_partkey % 10 NOT IN (3, 7) THEN cast(p_size AS string) END AS p_size,
             {REASON} AS reason, CASE WHEN p_partkey % 10 IN (3, 7) THEN {LINE} END AS line FROM part) t""")
def screened_table(v):
    read = part_lines(v)
    good = read.good.select(*PART_COLUMNS, F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("line"))
    return good.unionByName(read.refused.select(*PART_COLUMNS, col(screening.REASON).alias("reason"), col(screening.TEXT).alias("line")))


@case("screened_counts", f"SELECT coalesce({REASON}, 'good') AS reason, count(*) AS n FROM part GROUP BY 1")
def screened_counts(v):
    """The counts that the load itself took."""
    counts = part_lines(v).counts
    return v.spark.createDataFrame(list(counts.items()), "reason string, n long").filter("n > 0")


# Of eight customers one has a document that is cut off, one a list, one nothing and one no name.
DOCUMENT = """
    CASE c_custkey % 8 WHEN 1 THEN '{"id": "' || cast(c_custkey AS string) || '", "name": '
                       WHEN 2 THEN '["' || c_name || '"]' WHEN 3 THEN ' '
                       WHEN 4 THEN '{"id": "' || cast(c_custkey AS string) || '"}'
                       ELSE '{"id": "' || cast(c_custkey AS string) || '", "name": "' || c_name || '", "active": '
                           || CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END
                           || ', "entity_type": "' || lower(c_mktsegment) || '", "method_config": {"entityType": "' || lower(c_mktsegment) || '_set"}}' END"""


@case("screened_configs", f"""
SELECT cast(c_custkey AS string) AS file, CASE WHEN good THEN cast(c_custkey AS string) END AS id, CASE WHEN good THEN c_name END AS name,
       CASE WHEN good THEN c_acctbal > 0 END AS active, CASE WHEN good THEN lower(c_mktsegment) || '_set' END AS target,
       CASE c_custkey % 8 WHEN 1 THEN 'not JSON' WHEN 2 THEN 'not an object' WHEN 3 THEN 'empty' WHEN 4 THEN 'without name' END AS reason,
       CASE WHEN NOT good THEN {DOCUMENT} END AS document
FROM (SELECT *, c_custkey % 8 NOT IN (1, 2, 3, 4) AS good FROM customer) c""")
def screened_configs(v):
    """A file per config; those refused are told by their file."""
    source = work_path(v.spark, "configs")
    documents = v.customer.select(col("c_custkey").cast("string").alias("file"), F.expr(DOCUMENT).alias("value"))
    wholefiles.write_files(documents.repartition(8), source, "file", "value")
    read = screening.load_documents(v.spark, source, work_path(v.spark, "screened"), CONFIG, "*.txt")
    file = F.regexp_extract(screening.FILE, r"file=(\d+)", 1).alias("file")
    target = F.get_json_object("method_config", "$.entityType").alias("target")
    none = F.lit(None).cast("string")
    good = read.good.select(file, "id", "name", "active", target, none.alias("reason"), none.alias("document"))
    fields = [F.when(F.lit(False), col(n)).alias(n) for n in ("id", "name", "active")]
    refused = read.refused.select(
        file, *fields, none.alias("target"), col(screening.REASON).alias("reason"), F.regexp_replace(screening.TEXT, "\n$", "").alias("document")
    )
    return good.unionByName(refused)


# ---- pages ---------------------------------------------------------------------------------

# Parts of a brand are a listing in pages of 20. By the page's number and brand one page of five has not landed,
# one has twice, and one starts five items early.
PLACED = """
SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS position,
       count(*) OVER (PARTITION BY p_brand) AS total FROM {part}"""
KIND = "(floor({p} / 20) + cast(substring(p_brand, 7, 1) AS int)) % 5"
ITEM = "struct<Key:bigint>"


def landed_pages(v):
    """The pages as JSON text, each of one listing."""
    placed = v.spark.sql(PLACED, part=v.part)
    early = F.expr(f"{KIND.format(p='(position + 5)')} = 2 AND position % 20 >= 15 AND floor((position + 5) / 20) * 20 < total")
    on = F.array_compact(F.array(F.floor(col("position") / 20), F.when(early, F.floor((col("position") + 5) / 20))))
    entries = placed.select("p_brand", "total", F.explode(on).alias("page"), F.struct("position", "p_partkey").alias("entry"))
    pages = entries.groupBy("p_brand", "page", "total").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    kind = F.expr(KIND.format(p="(page * 20)"))
    doc = F.struct(
        F.transform("entries", lambda e: F.struct(e["p_partkey"].alias("Key"))).alias("Items"),
        F.struct(
            col("entries")[0]["position"].alias("Offset"), F.lit(20).alias("Limit"), F.size("entries").alias("DisplayedCount"), col("total").alias("TotalCount")
        ).alias("Paging"),
    )
    copies = F.when(kind == 0, 0).when(kind == 1, 2).otherwise(1)
    return pages.select("p_brand", F.to_json(doc).alias("value"), F.explode(F.array_repeat(F.lit(1), copies)).alias("n")).drop("n")


LANDED = f"""
placed AS ({PLACED.format(part="part")}),
landed AS (
  SELECT p_brand, floor(position / 20) AS page, position, p_partkey, total FROM placed WHERE {KIND.format(p="position")} <> 0
  UNION ALL
  SELECT p_brand, floor((position + 5) / 20), position, p_partkey, total FROM placed
  WHERE {KIND.format(p="(position + 5)")} = 2 AND position % 20 >= 15 AND floor((position + 5) / 20) * 20 < total
),
holes AS (
  SELECT p_brand, position, position - row_number() OVER (PARTITION BY p_brand ORDER BY position) AS island
  FROM placed WHERE (p_brand, position) NOT IN (SELECT p_brand, position FROM landed)
)"""


@case("missing_pages", f"""
WITH {LANDED}
SELECT p_brand, min(position) AS start, max(position) + 1 AS stop FROM holes
WHERE p_brand IN (SELECT p_brand FROM landed) GROUP BY p_brand, island""")
def missing_pages(v):
    return pages.missing_ranges(pages.page_spans(landed_pages(v), ["p_brand"], ITEM), ["p_brand"])


@case("page_completeness", f"""
WITH {LANDED},
counted AS (
  SELECT p_brand, sum(CASE WHEN kind = 1 THEN 2 ELSE 1 END) AS pages, count(*) FILTER (kind = 1) AS repeated
  FROM (SELECT DISTINCT p_brand, page, {KIND.format(p="(page * 20)")} AS kind FROM landed) p GROUP BY 1
),
covered AS (SELECT p_brand, max(total) AS total, count(*) - count(DISTINCT position) AS overlapping FROM landed GROUP BY 1),
gaps AS (SELECT p_brand, count(DISTINCT island) AS gaps, count(*) AS missing FROM holes GROUP BY 1)
SELECT c.p_brand, cast(pages AS bigint) AS pages, repeated, total, overlapping, coalesce(gaps, 0) AS gaps, coalesce(missing, 0) AS missing,
       CASE WHEN missing > 0 THEN 'incomplete' WHEN overlapping > 0 THEN 'overlapping' ELSE 'complete' END AS status
FROM counted c JOIN covered USING (p_brand) LEFT JOIN gaps USING (p_brand)""")
def page_completeness(v):
    return pages.completeness(pages.page_spans(landed_pages(v), ["p_brand"], ITEM), ["p_brand"])


@case("positioned_items", f"WITH {LANDED} SELECT DISTINCT p_brand, position, p_partkey FROM landed")
def positioned_items(v):
    found = pages.positioned_items(landed_pages(v), ["p_brand"], ITEM)
    return found.select("p_brand", "position", col("item")["Key"].alias("p_partkey"))


# ---- uploads and exports -------------------------------------------------------------------

@case("upload_table", "SELECT p_partkey, nullif(p_name, 'none') AS p_name, p_size FROM part")
def upload_table(v):
    """A sheet is uploaded as a named table, one that is there is replaced, then it is read by its name."""
    folder, name = work_path(v.spark, "sheets"), f"parts_{uuid.uuid4().hex}"
    delimited.write_entity_table(v.part.select("p_partkey", "p_name", "p_size"), f"{folder}/sheet.tsv")
    for _ in range(2):
        catalog.upload_tables(v.spark, [f"{folder}/sheet.tsv"], [name], overwrite=True, location=folder)
    kinds = {"p_partkey": "bigint", "p_name": "string", "p_size": v.part.schema["p_size"].dataType}
    return v.spark.table(name).select(*[col(n).cast(kind).alias(n) for n, kind in kinds.items()])


@case("export_table", """
SELECT cast(c_custkey AS string) AS c_custkey, c_mktsegment, c_name FROM customer
WHERE regexp_matches(lower(c_mktsegment), 'build|auto')""")
def export_table(v):
    folder = work_path(v.spark, "export")
    delimited.export_table(v.customer, folder, ["c_name", "c_mktsegment"], terms=["BUILD", "auto"], columns_searched=["c_mktsegment"])
    return delimited.read_entity_table(v.spark, folder)


RECENT = f"SELECT id, created_at FROM samples WHERE submitted_at IS NULL AND uploaded_at IS NULL AND {{when}}"


# A day in the middle of the orders.
TODAY = "1998-03-05"


@case("created_today", RECENT.format(when=f"created_at >= timestamp '{TODAY}' AND created_at < timestamp '{TODAY}' + INTERVAL 1 DAY"), ("samples",))
def created_today(v):
    return lookup.created_today(v.samples, f"{TODAY} 12:00:00").select("id", "created_at")


@case("recent_hours", RECENT.format(when=f"created_at >= {NOW} - INTERVAL 720 HOUR"), ("samples",))
def recent_hours(v):
    return lookup.recent_hours(v.samples, 720, as_of=ORDERS_AS_OF).select("id", "created_at")
