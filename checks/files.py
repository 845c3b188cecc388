"""Sequencing datasets and files."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import case
from samplyard.functions.columns import col
from samplyard.operators import rounds, seqfiles
from samplyard.plans import fetch
from samplyard.session import work_path
from samplyard.sources import datasets as source

# How the two reads of a pair and the lane of a dataset are told by a name.
R1 = r"regexp_matches(file_name, '(?i)[_-]R1.*\.fastq\.gz$')"
R2 = r"regexp_matches(file_name, '(?i)[_-]R2.*\.fastq\.gz$')"
BARE = r"regexp_replace({c}, '(?i)[_-]L\d{{1,3}}(_R[12].*|)$', '\1')"


# ---- parsing -------------------------------------------------------------------------------

def run_items(v, orders=None):
    """Runs: one per order, named like its customer, as search item text; only pending ones are of type run."""
    orders = v.orders if orders is None else orders
    run = F.struct(
        col("o_orderkey").cast("string").alias("Id"),
        F.concat(F.lit("run "), "o_orderkey").alias("Name"),
        F.concat(F.lit("Customer#"), F.lpad(col("o_custkey").cast("string"), 9, "0")).alias("ExperimentName"),
    )
    item = F.struct(F.when((col("o_orderpriority") == "5-LOW") | ~col("o_orderstatus").eqNullSafe("P"), "Unknown").otherwise("Run").alias("Type"), run.alias("Run"))
    return orders.select(F.to_json(item).alias("value"))


def project_items(v, customers=None):
    """Projects: one per customer; only those with a positive balance are of type project."""
    customers = v.customer if customers is None else customers
    project = F.struct(col("c_custkey").cast("string").alias("Id"), col("c_name").alias("Name"))
    item = F.struct(F.when(col("c_acctbal") > 0, "PROJECT").otherwise("Unknown").alias("Type"), project.alias("Project"))
    return customers.select(F.to_json(item).alias("value"))


ITEMS = """
SELECT type, CASE WHEN type <> 'other' THEN id END AS id, CASE WHEN type <> 'other' THEN name END AS name,
       CASE WHEN type = 'run' THEN experiment_name END AS experiment_name
FROM (SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority <> '5-LOW' THEN 'run' ELSE 'other' END AS type,
             cast(o_orderkey AS string) AS id, 'run ' || cast(o_orderkey AS string) AS name,
             'Customer#' || lpad(cast(o_custkey AS string), 9, '0') AS experiment_name
      FROM orders
      UNION ALL
      SELECT CASE WHEN c_acctbal > 0 THEN 'project' ELSE 'other' END, cast(c_custkey AS string), c_name, NULL FROM customer) items"""


def all_items(v):
    return source.parse_search_items(source.union_scopes(run_items(v), project_items(v)))


@case("parse_search_items", ITEMS)
def parse_search_items(v):
    return all_items(v).drop("raw")


@case("union_scopes", f"""
SELECT CASE type WHEN 'run' THEN 'runs' ELSE 'projects' END AS scope, CASE type WHEN 'run' THEN experiment_name ELSE name END AS name, id AS item_id
FROM ({ITEMS}) t WHERE type <> 'other'""")
def union_scopes(v):
    return source.collection_items(all_items(v))


HITS = f"""
SELECT name, count(*) FILTER (scope = 'runs') AS runs, count(*) FILTER (scope = 'projects') AS projects,
       min(item_id) FILTER (scope = 'runs') AS run_id, min(item_id) FILTER (scope = 'projects') AS project_id
FROM (SELECT CASE type WHEN 'run' THEN 'runs' ELSE 'projects' END AS scope, CASE type WHEN 'run' THEN experiment_name ELSE name END AS name, id AS item_id
      FROM ({ITEMS}) t WHERE type <> 'other') u GROUP BY 1"""


@case("resolve_names", f"""
WITH hits AS ({HITS})
SELECT c_name AS name, CASE WHEN h.name IS NULL THEN 'missing' WHEN runs > 0 AND projects > 0 THEN 'ambiguous_scope'
         WHEN runs > 1 OR projects > 1 THEN 'duplicate' ELSE 'resolved' END AS status,
       CASE WHEN runs + projects = 1 THEN CASE WHEN runs = 1 THEN 'runs' ELSE 'projects' END END AS scope,
       CASE WHEN runs + projects = 1 THEN coalesce(run_id, project_id) END AS item_id
FROM customer LEFT JOIN hits h ON c_name = h.name""")
def resolve_names(v):
    asked = v.customer.select(F.concat(F.lit(" "), "c_name").alias("name"))
    return seqfiles.resolve_names(asked, source.collection_items(all_items(v)))


@case("resolve_names_priority", f"""
WITH hits AS ({HITS})
SELECT c_name AS name, CASE WHEN h.name IS NULL THEN 'missing' WHEN projects > 0 THEN 'resolved' WHEN runs > 1 THEN 'duplicate' ELSE 'resolved' END AS status,
       CASE WHEN projects > 0 THEN 'projects' WHEN runs = 1 THEN 'runs' END AS scope,
       CASE WHEN projects > 0 THEN project_id WHEN runs = 1 THEN run_id END AS item_id
FROM customer LEFT JOIN hits h ON c_name = h.name""")
def resolve_names_priority(v):
    return seqfiles.resolve_names(v.customer.select(col("c_name").alias("name")), source.collection_items(all_items(v)), "projects")


def dataset_texts(v):
    """Datasets as JSON text, with seven fractional digits in the date."""
    d = v.dataset_rows
    doc = F.struct(
        col("dataset_id").alias("Id"),
        col("name").alias("Name"),
        F.date_format("date_created", "yyyy-MM-dd'T'HH:mm:ss'.1234567Z'").alias("DateCreated"),
        F.when(col("type_id") != "common.bam", F.struct(col("type_id").alias("Id"), col("conforms_to").alias("ConformsToIds"))).alias("DatasetType"),
        F.struct(
            F.struct(col("is_paired_end").alias("IsPairedEnd"), col("bytes").alias("TotalReadsPF"), F.col("quantity").cast("bigint").alias("MaxLengthRead1")).alias("common_fastq")
        ).alias("Attributes"),
    )
    return d.select(F.to_json(doc).alias("value"))


@case("parse_datasets", """
SELECT dataset_id, name, date_created + INTERVAL 123456 MICROSECOND AS date_created,
       CASE WHEN type_id <> 'common.bam' THEN type_id END AS type_id,
       CASE WHEN is_vendor THEN 'common.fastq,common.files' WHEN type_id <> 'common.bam' THEN '' END AS conforms,
       is_paired_end, bytes AS total_reads_pf, cast(quantity AS bigint) AS max_length_read1, cast(NULL AS bigint) AS total_clusters_pf
FROM datasets""", ("datasets",))
def parse_datasets(v):
    return source.parse_datasets(dataset_texts(v)).select(
        "dataset_id", "name", "date_created", "type_id",
        F.array_join("conforms_to", ",").alias("conforms"),
        "is_paired_end", "total_reads_pf", "max_length_read1", "total_clusters_pf",
    )


@case("parse_dataset_files", "SELECT dataset_id, file_id, file_name, size FROM files", ("files",))
def parse_dataset_files(v):
    item = F.struct(col("file_id").alias("Id"), col("file_name").alias("Name"), col("size").alias("Size"))
    pages = v.files.groupBy("dataset_id").agg(F.collect_list(item).alias("Items"))
    text = pages.select("dataset_id", F.to_json(F.struct("Items")).alias("value"))
    return source.flatten_files(source.parse_page(text, source.FILE))


# ---- datasets ------------------------------------------------------------------------------

TYPED = "(type_id = 'common.fastq' OR is_vendor)"


@case("dataset_type_filter", f"SELECT dataset_id, name, type_id FROM datasets WHERE {TYPED}", ("datasets",))
def dataset_type_filter(v):
    return v.dataset_rows.filter(seqfiles.of_type(["common.fastq"])).select("dataset_id", "name", "type_id")


@case("duplicate_names", "SELECT name, count(*) AS copies FROM datasets GROUP BY 1 HAVING count(*) > 1", ("datasets",))
def duplicate_names(v):
    return seqfiles.duplicate_names(v.datasets)


RANKED = """SELECT name, dataset_id, date_created, count(*) OVER (PARTITION BY name) AS copies,
       count(*) OVER (PARTITION BY name, date_created) > 1 AS tie
FROM datasets QUALIFY row_number() OVER (PARTITION BY name ORDER BY date_created DESC, dataset_id) = 1"""


@case("latest_dataset", f"SELECT * FROM ({RANKED}) t WHERE NOT tie", ("datasets",))
def latest_dataset(v):
    return seqfiles.latest_per_name(v.datasets, ["name"]).filter(~col("tie"))


@case("latest_ties", f"SELECT name, date_created, copies FROM ({RANKED}) t WHERE tie", ("datasets",))
def latest_ties(v):
    return seqfiles.latest_per_name(v.datasets, ["name"]).filter("tie").select("name", "date_created", "copies")


OFFERED = f"""
offers AS (SELECT name AS sample, 0 AS sibling, * FROM datasets
           UNION ALL SELECT {BARE.format(c='name')}, 1, * FROM datasets WHERE {BARE.format(c='name')} <> name),
named AS (SELECT sample, sibling, name, dataset_id, count(*) OVER (PARTITION BY sample, sibling, name) AS copies,
                 count(*) OVER (PARTITION BY sample, sibling, name, date_created) > 1 AS tie
          FROM offers QUALIFY row_number() OVER (PARTITION BY sample, sibling, name ORDER BY date_created DESC, dataset_id) = 1),
wanted AS (SELECT 'D' || cast(o_orderkey AS string) AS sample FROM orders),
best AS (SELECT sample, min(sibling) AS sibling FROM named GROUP BY 1),
over_all AS (SELECT w.sample, b.sibling, bool_or(n.copies > 1) AS dup, bool_or(n.tie) AS tie
             FROM wanted w LEFT JOIN best b ON w.sample = b.sample
             LEFT JOIN named n ON n.sample = b.sample AND n.sibling = b.sibling GROUP BY 1, 2)"""


def match_sql(status):
    return f"""
WITH {OFFERED},
judged AS (SELECT sample, sibling, {status} AS status FROM over_all)
SELECT j.sample, j.status, n.dataset_id, n.name FROM judged j
LEFT JOIN named n ON j.status IN ('exact', 'lanes') AND n.sample = j.sample AND n.sibling = j.sibling"""


def requests(v):
    return v.orders.select(F.concat(F.lit("D"), "o_orderkey").alias("sample"))


@case("match_datasets", match_sql("""CASE WHEN sibling IS NULL THEN 'missing' WHEN dup THEN 'duplicate' WHEN sibling = 0 THEN 'exact' ELSE 'lanes' END"""), ("datasets",))
def match_datasets(v):
    return seqfiles.match_datasets(requests(v), v.datasets, group_by_lane=True)


@case("match_datasets_latest", match_sql("""CASE WHEN sibling IS NULL THEN 'missing' WHEN sibling = 1 THEN 'partial' WHEN tie THEN 'tie' ELSE 'exact' END"""), ("datasets",))
def match_datasets_latest(v):
    return seqfiles.match_datasets(requests(v), v.datasets, use_latest=True)


COUNTED = f"""SELECT dataset_id, count(*) AS files, count(*) FILTER ({R1}) AS r1, count(*) FILTER ({R2}) AS r2,
       coalesce(sum(coalesce(size, 0)) FILTER ({R1}), 0) AS b1, coalesce(sum(coalesce(size, 0)) FILTER ({R2}), 0) AS b2,
       bool_and(is_paired_end) AS paired FROM files GROUP BY 1"""


@case("dataset_sheet", f"""
SELECT d.name AS dataset_name, d.dataset_id, printf('%.2f MB', b1 / 1000000.0) AS read1_concat_size_mb,
       printf('%.2f MB', b2 / 1000000.0) AS read2_concat_size_mb, files AS num_files, type_id AS dataset_type, is_paired_end,
       r1 <> 0 AND r1 = r2 AND r1 + r2 = files AS is_balanced
FROM datasets d JOIN ({COUNTED}) c ON d.dataset_id = c.dataset_id""", ("datasets", "files"))
def dataset_sheet(v):
    return seqfiles.dataset_sheet(v.datasets, v.files)


@case("paired_check", f"""
SELECT dataset_id, CASE WHEN NOT paired THEN 'not_paired' WHEN r1 <> 0 AND r1 = r2 AND r1 + r2 = files THEN 'ok' ELSE 'unbalanced' END AS status,
       files, r1 AS r1_files, r2 AS r2_files FROM ({COUNTED}) c""", ("files",))
def paired_check(v):
    return seqfiles.paired_check(v.files, ["dataset_id"])


SAMPLE = "split_part(dataset_id, '-', 1)"


def sample_files(v):
    """Files with the sample (order) they belong to; file names get a varying index token."""
    name = F.when(
        col("size") > 9_000_000, F.regexp_replace("file_name", "_001[.]fastq", "_002.fastq")
    ).otherwise(col("file_name"))
    return v.files.select(F.split_part("dataset_id", F.lit("-"), F.lit(1)).alias("sample"), "file_id", name.alias("file_name"), "size")


NAMED = f"""named_files AS (SELECT {SAMPLE} AS sample, file_id,
    CASE WHEN size > 9000000 THEN replace(file_name, '_001.fastq', '_002.fastq') ELSE file_name END AS file_name, size FROM files)"""


@case("lane_naming_check", f"""
WITH {NAMED}
SELECT sample, read, count(DISTINCT {BARE.format(c='file_name')}) AS bare_names
FROM (SELECT *, CASE WHEN {R1} THEN 'R1' WHEN {R2} THEN 'R2' END AS read FROM named_files) f
WHERE read IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT {BARE.format(c='file_name')}) > 1""", ("files",))
def lane_naming_check(v):
    return seqfiles.lane_naming_check(seqfiles.files_by_read(sample_files(v)), ["sample", "read"])


@case("expected_size", f"""
SELECT {SAMPLE} AS sample, CASE WHEN count(size) = count(*) THEN cast(sum(size) AS bigint) END AS expected_size, count(*) AS files
FROM files GROUP BY 1""", ("files",))
def expected_size(v):
    return seqfiles.expected_size(sample_files(v), ["sample"])


ORDERED = f"""
SELECT sample, read, file_name, file_id, row_number() OVER w AS position,
       cast(coalesce(sum(size) OVER (PARTITION BY sample, read ORDER BY file_name, file_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bigint) AS "offset", size
FROM (SELECT *, CASE WHEN {R1} THEN 'R1' WHEN {R2} THEN 'R2' END AS read FROM named_files) f
WHERE read IS NOT NULL WINDOW w AS (PARTITION BY sample, read ORDER BY file_name, file_id)"""


@case("read_file_lists", f"WITH {NAMED} {ORDERED}", ("files",))
def read_file_lists(v):
    return seqfiles.read_file_lists(sample_files(v), ["sample"])


@case("concat_plan", f"""
WITH {NAMED} SELECT sample, read, sample || '_' || read || '.fastq.gz' AS output_name, position, file_name, size, "offset" FROM ({ORDERED}) o""", ("files",))
def concat_plan(v):
    return seqfiles.concat_plan(sample_files(v))


# ---- fetching ------------------------------------------------------------------------------

def owned_datasets(v):
    """Datasets with the item that their order belongs to, joined in rounds and staged: their files have the same one."""
    owner = v.orders.select(col("o_orderkey").cast("string").alias("order_key"), col("o_custkey").cast("string").alias("item_id"))
    key = F.split_part("dataset_id", F.lit("-"), F.lit(1)).alias("order_key")
    datasets, path = v.dataset_rows.select("*", key), work_path(v.spark, "owned")
    n = rounds.rounds_of(datasets, owner, most=2)
    for k in range(n):
        mine = rounds.hash_class(["order_key"], n) == k
        rounds.put(datasets.filter(mine).join(owner.filter(mine), "order_key"), path)
    return v.spark.read.schema(datasets.join(owner, "order_key").schema).parquet(path)


def fetch_inputs(v):
    """Every order asks its own sample in the collection of its customer; low ones ask twice."""
    asked = v.orders.select(
        F.concat(F.lit("Customer#"), F.lpad(col("o_custkey").cast("string"), 9, "0")).alias("collection"),
        F.concat(F.lit("D"), "o_orderkey").alias("sample"),
        col("o_orderpriority").alias("p"),
    )
    asked = asked.select("collection", "sample").unionByName(asked.filter("p = '5-LOW'").select("collection", "sample"))
    items = v.customer.filter("c_acctbal > 0").select(
        F.lit("projects").alias("scope"), col("c_name").alias("name"), col("c_custkey").cast("string").alias("item_id")
    )
    datasets = owned_datasets(v)
    return asked, items, datasets, v.files_of(datasets, "order_key", "item_id")


@case("fetch_plan", f"""
WITH typed AS (SELECT * FROM datasets WHERE {TYPED}),
offers AS (SELECT name AS sample, 0 AS sibling, * FROM typed
           UNION ALL SELECT {BARE.format(c='name')}, 1, * FROM typed WHERE {BARE.format(c='name')} <> name),
named AS (SELECT sample, sibling, name, dataset_id, is_paired_end, count(*) OVER (PARTITION BY sample, sibling, name, date_created) > 1 AS tie
          FROM offers QUALIFY row_number() OVER (PARTITION BY sample, sibling, name ORDER BY date_created DESC, dataset_id) = 1),
wanted AS (SELECT 'D' || cast(o_orderkey AS string) AS sample, o_custkey, c_name AS collection, o_orderpriority, c_acctbal
           FROM orders JOIN customer ON o_custkey = c_custkey),
best AS (SELECT sample, min(sibling) AS sibling FROM named GROUP BY 1),
chosen AS (SELECT n.* FROM named n JOIN best b ON n.sample = b.sample AND n.sibling = b.sibling),
seen AS (SELECT sample, bool_or(tie) AS tie, bool_and(is_paired_end) AS paired, count(*) AS datasets FROM chosen GROUP BY 1),
counted AS (SELECT c.sample, count(*) AS files, count(*) FILTER ({R1}) AS r1, count(*) FILTER ({R2}) AS r2,
                   coalesce(sum(coalesce(size, 0)) FILTER ({R1}), 0) AS b1, coalesce(sum(coalesce(size, 0)) FILTER ({R2}), 0) AS b2
            FROM chosen c JOIN files f ON c.dataset_id = f.dataset_id GROUP BY 1),
judged AS (SELECT w.*, s.tie, s.datasets, k.files, k.r1, k.r2, k.b1, k.b2,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'requested_twice' WHEN c_acctbal <= 0 THEN 'collection_missing'
            WHEN s.sample IS NULL THEN 'missing' WHEN s.tie THEN 'tie' WHEN NOT s.paired THEN 'not_paired'
            WHEN NOT (r1 <> 0 AND r1 = r2 AND r1 + r2 = files) THEN 'unbalanced' ELSE 'ok' END AS status
  FROM wanted w LEFT JOIN seen s ON w.sample = s.sample LEFT JOIN counted k ON w.sample = k.sample)
SELECT collection, sample, CASE WHEN c_acctbal > 0 THEN cast(o_custkey AS string) END AS item_id, status,
       CASE WHEN status IN ('ok', 'not_paired', 'unbalanced') THEN datasets ELSE 0 END AS datasets,
       CASE WHEN status IN ('ok', 'not_paired', 'unbalanced') THEN files ELSE 0 END AS files,
       CASE WHEN status IN ('ok', 'not_paired', 'unbalanced') THEN r1 ELSE 0 END AS r1_files,
       CASE WHEN status IN ('ok', 'not_paired', 'unbalanced') THEN r2 ELSE 0 END AS r2_files,
       CASE WHEN status IN ('ok', 'not_paired', 'unbalanced') THEN cast(b1 AS bigint) ELSE 0 END AS r1_bytes,
       CASE WHEN status IN ('ok', 'not_paired', 'unbalanced') THEN cast(b2 AS bigint) ELSE 0 END AS r2_bytes
FROM judged""", ("datasets", "files"))
def fetch_plan(v):
    asked, items, datasets, files = fetch_inputs(v)
    return fetch.fetch_plan(asked, items, datasets, files, group_by_lane=True, use_latest=True)["results"]
