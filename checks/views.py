"""Samples, configs, workflows, datasets and files as views over the given tables.

The text of a view is plain SQL that Spark and DuckDB both read; ``{orders}`` and the like stand
for the tables. They make nulls, empty texts and repeats out of the values, row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "pages", "benchmark", "labels", "conversations",
)

# The moment the queries are run for: orders end on this day, events on the next.
ORDERS_AS_OF = "2001-08-01 12:00:00"
EVENTS_AS_OF = "2024-01-30 23:59:59"

VIEWS = {
    "samples": """
        SELECT cast(o_orderkey AS string) AS id,
               'S' || cast(o_orderkey AS string) AS sample_id,
               cast(o_custkey AS string) AS config_id,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS entity_type,
               o_orderdate AS created_at,
               nullif(o_orderdate, o_orderdate) AS updated_at,
               CASE WHEN o_orderstatus IN ('P', 'F') THEN o_orderdate + INTERVAL 1 DAY END AS uploaded_at,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 2 DAY END AS submitted_at,
               CASE WHEN o_orderstatus IN ('P', 'F') THEN 'set_' || o_orderpriority END AS upload_source,
               CASE WHEN o_orderstatus = 'F' THEN 'sub_' || cast(o_custkey AS string) END AS submission_id,
               CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' THEN ''
                    WHEN o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'
                    THEN 'wf_' || cast(o_orderkey AS string) END AS workflow_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Succeeded' WHEN '2-HIGH' THEN 'Failed'
                    WHEN '3-MEDIUM' THEN 'Running' WHEN '4-NOT SPECIFIED' THEN '' END AS workflow_state
        FROM {orders}""",
    "configs": """
        SELECT cast(c_custkey AS string) AS id,
               c_name AS name,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN lower(c_mktsegment) END AS entity_type,
               c_acctbal > 0 AS active,
               CASE WHEN c_nationkey < 8 THEN NULL ELSE c_nationkey >= 16 END AS transferred,
               '{"entityType": "' || lower(c_mktsegment) || '_set", "rootNode": {"key": '
                   || cast(c_nationkey AS string) || '}}' AS method_config,
               CASE WHEN c_nationkey < 20 THEN 'lab_' || cast(c_nationkey AS string) END AS prefix,
               timestamp '2024-01-01 00:00:00' AS created_at
        FROM {customer}""",
    "raw_orders": """
        SELECT CASE WHEN o_orderpriority <> '5-LOW' OR o_orderstatus <> 'F'
                    THEN 'S' || cast(o_orderkey AS string) END AS entity_id,
               cast(o_custkey AS string) AS config,
               o_orderpriority AS priority,
               CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' THEN 'n/a'
                    ELSE cast(cast(o_totalprice AS decimal(12, 2)) AS string) END AS src_total,
               CASE o_orderpriority WHEN '1-URGENT' THEN cast(o_custkey AS string)
                    WHEN '2-HIGH' THEN cast(o_custkey AS string) || '.0'
                    WHEN '3-MEDIUM' THEN cast(o_custkey AS string) || '.5'
                    WHEN '5-LOW' THEN '1e3' ELSE 'none' END AS src_units,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'TRUE' WHEN '2-HIGH' THEN '0'
                    WHEN '3-MEDIUM' THEN 'yes' WHEN '5-LOW' THEN 'false' END AS src_rush,
               CASE WHEN o_orderpriority = '1-URGENT' THEN y || '-' || m || '-' || d
                    WHEN o_orderpriority = '2-HIGH' THEN m || '/' || d || '/' || y
                    WHEN o_orderpriority = '3-MEDIUM' THEN d || '/' || m || '/' || y
                    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN y || m || d
                    WHEN o_orderstatus = 'F' THEN y || '-' || m || '-' || d || 'T10:30:45Z'
                    WHEN o_orderstatus = 'P' THEN '' END AS src_collected,
               CASE WHEN o_orderstatus <> 'O'
                    THEN 'gs://intake/run' || y || '/' || cast(o_orderkey AS string) || '_R1.fastq.gz'
                    WHEN o_orderpriority = '1-URGENT' THEN '' END AS read1,
               CASE WHEN o_orderstatus = 'F' OR o_orderpriority = '2-HIGH'
                    THEN 'gs://archive/run' || y || '/' || cast(o_orderkey AS string) || '_R2.fastq.gz'
                    END AS read2,
               'x' AS extra
        FROM (SELECT *, cast(extract(year FROM o_orderdate) AS string) AS y,
                     lpad(cast(extract(month FROM o_orderdate) AS string), 2, '0') AS m,
                     lpad(cast(extract(day FROM o_orderdate) AS string), 2, '0') AS d
              FROM {orders}) AS dated""",
    "sync_target": """
        SELECT cast(o_orderkey AS string) AS id,
               'S' || cast(o_orderkey AS string) AS sample_id,
               cast(o_custkey AS string) AS config_id,
               o_orderdate AS created_at,
               nullif(o_orderdate, o_orderdate) AS updated_at,
               CASE WHEN o_orderstatus = 'P' THEN 'old' WHEN o_orderstatus = 'F' THEN '' END AS lab,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS stage,
               CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END AS total
        FROM {orders}""",
    "sync_source": """
        SELECT 'S' || cast(o_orderkey AS string) AS entity_id,
               cast(o_custkey AS string) AS config_id,
               CASE WHEN o_orderpriority = '1-URGENT' THEN '' WHEN o_orderpriority = '2-HIGH' THEN 'old'
                    WHEN o_orderpriority <> '3-MEDIUM' THEN 'new' END AS lab,
               CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'P' THEN NULL
                    ELSE o_orderpriority END AS stage,
               cast(cast(o_totalprice AS decimal(12, 2)) AS string) AS src_total,
               1 AS version
        FROM {orders}
        UNION ALL
        SELECT 'S' || cast(o_orderkey AS string), cast(o_custkey AS string), 'later', 'later', '0', 2
        FROM {orders} WHERE o_orderstatus = 'P'""",
    "order_workflows": """
        SELECT 'sub_' || cast(o_custkey AS string) AS submission_id,
               o_orderdate AS submission_date,
               o_orderkey AS position,
               CASE WHEN o_totalprice > 50000 THEN 'wf_' || cast(o_orderkey AS string) END AS workflow_id,
               'S' || cast(o_orderkey AS string) AS entity_name,
               CASE WHEN o_totalprice > 400000 THEN 'Succeeded' WHEN o_totalprice > 300000 THEN 'Failed'
                    WHEN o_totalprice > 200000 THEN 'Running' WHEN o_totalprice > 100000 THEN 'Aborted'
                    END AS status
        FROM {orders}""",
    "user_samples": """
        SELECT cast(c_custkey AS string) AS id,
               'U' || cast(c_custkey AS string) AS sample_id,
               CASE WHEN c_acctbal < 0 THEN 'sub_old' END AS submission_id,
               CASE WHEN c_nationkey < 12 THEN c_mktsegment END AS lab
        FROM {customer}""",
    "datasets": """
        SELECT cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) || '-'
                   || cast(l_partkey AS string) || '-' || cast(l_suppkey AS string) AS dataset_id,
               'D' || cast(l_orderkey AS string)
                   || CASE WHEN l_linenumber < 7 THEN '_L00' || cast(l_linenumber AS string) ELSE '' END AS name,
               l_shipdate AS date_created,
               CASE l_returnflag WHEN 'A' THEN 'common.fastq' WHEN 'R' THEN 'vendor.fastq' ELSE 'common.bam' END AS type_id,
               l_returnflag = 'R' AS is_vendor,
               l_linestatus = 'O' OR l_returnflag = 'A' AS is_paired_end,
               l_quantity AS quantity,
               cast(round(l_extendedprice * 100) AS bigint) AS bytes
        FROM {lineitem}""",
    "files": """
        SELECT dataset_id, dataset_id || '-' || side AS file_id,
               name || '_' || side || '_001.fastq.gz' AS file_name,
               CASE WHEN quantity > 2 THEN CASE WHEN side = 'R1' THEN bytes ELSE bytes + 1 END END AS size,
               name AS dataset_name, is_paired_end
        FROM (SELECT cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) || '-'
                         || cast(l_partkey AS string) || '-' || cast(l_suppkey AS string) AS dataset_id,
                     'D' || cast(l_orderkey AS string)
                         || CASE WHEN l_linenumber < 7 THEN '_L00' || cast(l_linenumber AS string) ELSE '' END AS name,
                     l_linestatus = 'O' OR l_returnflag = 'A' AS is_paired_end,
                     l_quantity AS quantity,
                     cast(round(l_extendedprice * 100) AS bigint) AS bytes
              FROM {lineitem}) AS d
        CROSS JOIN (SELECT 'R1' AS side UNION ALL SELECT 'R2' UNION ALL SELECT 'I1') AS sides
        WHERE side = 'R1' OR (side = 'R2' AND quantity < 45) OR (side = 'I1' AND quantity < 3)""",
}


def _placeholders(text: str) -> list[str]:
    return [t for t in TABLES if "{" + t + "}" in text]


def with_views(sql: str, using: tuple[str, ...]) -> str:
    """The SQL with the views it reads as leading common table expressions."""
    parts = []
    for name in using:
        text = VIEWS[name]
        for table in _placeholders(text):
            text = text.replace("{" + table + "}", table)
        parts.append(f"{name} AS ({text})")
    body = sql.strip()
    if not parts:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body


class Views:
    """Tables of one data folder and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str, **instead: DataFrame) -> DataFrame:
        """The view over the tables, or over the frames given instead."""
        text = VIEWS[name]
        for literal in ('{"entityType"', '{"key"', "}}'"):
            text = text.replace(literal, literal.replace("{", "{{").replace("}", "}}"))
        return self.spark.sql(text, **{t: instead.get(t) or self.table(t) for t in _placeholders(text)})

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        if name in VIEWS:
            return self.view(name)
        raise AttributeError(name)

    @property
    def files(self) -> DataFrame:
        """R1 and R2 files of every dataset; some lack R2, some have an index file too."""
        return self.files_of(self.view("datasets"))

    def files_of(self, datasets: DataFrame, *keep: str) -> DataFrame:
        """The files of the given rows of datasets, with the columns to keep."""
        size = F.when(F.col("quantity") > 2, F.col("bytes") + F.when(F.col("side") == "R1", 0).otherwise(1))
        there = F.expr("side = 'R1' OR (side = 'R2' AND quantity < 45) OR (side = 'I1' AND quantity < 3)")
        sides = F.explode(F.array(F.lit("R1"), F.lit("R2"), F.lit("I1")))
        return datasets.withColumn("side", sides).filter(there).select(
            "dataset_id",
            F.concat_ws("-", "dataset_id", "side").alias("file_id"),
            F.concat("name", F.lit("_"), "side", F.lit("_001.fastq.gz")).alias("file_name"),
            size.alias("size"),
            F.col("name").alias("dataset_name"),
            "is_paired_end",
            *keep,
        )

    @property
    def raw(self) -> DataFrame:
        """The raw orders in the layout of an entity table."""
        return self.raw_orders.withColumnRenamed("entity_id", "entity:order_id")

    @property
    def submission_documents(self) -> DataFrame:
        """Submissions of up to 100 workflows each, one JSON document per row."""
        events = self.events
        status = F.element_at(
            F.create_map(
                *[F.lit(x) for x in ("click", "Succeeded", "error", "Failed", "purchase", "Running", "signup", "Aborted")]
            ),
            F.col("event_type"),
        )
        workflow = F.struct(
            F.col("event_id").alias("n"),
            F.when(F.col("event_type") != "view", F.concat(F.lit("wf_"), "event_id")).alias("workflowId"),
            status.alias("status"),
            F.struct(F.when(F.col("value") >= 1, F.concat(F.lit("U"), "user_id")).alias("entityName")).alias("workflowEntity"),
        )
        grouped = events.groupBy(F.floor(F.col("event_id") / 100).alias("s")).agg(
            F.sort_array(F.collect_list(workflow)).alias("workflows"),
            F.min("ts").alias("started"),
            F.min_by("event_type", "event_id").alias("first_type"),
        )
        doc = F.struct(
            F.concat(F.lit("sub_"), "s").alias("submissionId"),
            F.when(F.col("first_type") == "error", "Aborted").otherwise("Done").alias("status"),
            F.date_format("started", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("submissionDate"),
            F.struct(F.when(F.col("first_type") != "view", F.concat(F.lit("set_"), "s")).alias("entityName")).alias("submissionEntity"),
            F.col("workflows"),
        )
        return grouped.select(F.to_json(doc).alias("value"))

    @property
    def entity_pages(self) -> DataFrame:
        """Parts as pages of up to 500 entities, one JSON document per row."""
        entity = F.struct(
            F.concat(F.lit("P"), "p_partkey").alias("name"),
            F.create_map(
                F.lit("p_name"), F.col("p_name"),
                F.lit("p_brand"), F.col("p_brand"),
                F.lit("part_id"), F.lit("not the id"),
                F.lit("p_size"), F.when(F.col("p_size") <= 40, F.col("p_size").cast("string")),
            ).alias("attributes"),
        )
        pages = self.part.groupBy(F.floor(F.col("p_partkey") / 500).alias("page")).agg(
            F.collect_list(entity).alias("results")
        )
        return pages.select(F.to_json(F.struct("results")).alias("value"))

    @property
    def dataset_rows(self) -> DataFrame:
        """Datasets with the list of types they conform to."""
        conforms = F.when(F.col("is_vendor"), F.array(F.lit("common.fastq"), F.lit("common.files")))
        return self.datasets.withColumn("conforms_to", F.coalesce(conforms, F.array().cast("array<string>")))


# Flat workflows of the submission documents, for the SQL side.
FLAT_WORKFLOWS = """
    SELECT 'sub_' || cast(event_id // 100 AS string) AS submission_id,
           date_trunc('second', min(ts) OVER s) AS submission_date,
           row_number() OVER (PARTITION BY event_id // 100 ORDER BY event_id) - 1 AS position,
           CASE WHEN event_type <> 'view' THEN 'wf_' || cast(event_id AS string) END AS workflow_id,
           CASE WHEN value >= 1 THEN 'U' || cast(user_id AS string) END AS entity_name,
           CASE event_type WHEN 'click' THEN 'Succeeded' WHEN 'error' THEN 'Failed'
                WHEN 'purchase' THEN 'Running' WHEN 'signup' THEN 'Aborted' END AS raw_status,
           CASE WHEN arg_min(event_type, event_id) OVER s <> 'view'
                THEN 'set_' || cast(event_id // 100 AS string) END AS upload_source,
           CASE WHEN arg_min(event_type, event_id) OVER s = 'error' THEN 'Aborted' ELSE 'Done' END AS doc_status
    FROM events
    WINDOW s AS (PARTITION BY event_id // 100)
"""
