"""From requested sample names to the files to fetch and concatenate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplyard.functions.columns import col
from samplyard.functions.names import trimmed
from samplyard.operators import seqfiles
from samplyard.operators.joins import keyed_join
from samplyard.operators.rounds import hash_class, put, rounds_of
from samplyard.session import work_path

#: The most rounds of a plan.
ROUNDS = 12
COUNTS = ("files", "r1_files", "r2_files", "r1_bytes", "r2_bytes")


def resolve_requests(requests: DataFrame, items: DataFrame, priority: str | None = None) -> DataFrame:
    """Requests (collection, sample) with the resolved collection, or why there is none.

    A sample asked for twice in a collection is refused.
    """
    clean = requests.select(trimmed(col("collection")).alias("collection"), trimmed(col("sample")).alias("sample"))
    counted = clean.groupBy("collection", "sample").agg(F.count(F.lit(1)).alias("__asked"))
    joined = seqfiles.with_resolved(counted, items.withColumnRenamed("name", "collection"), priority, "collection").withColumnRenamed("status", "collection_status")
    problem = F.when(col("__asked") > 1, "requested_twice").when(
        col("collection_status") != "resolved", F.concat(F.lit("collection_"), col("collection_status"))
    )
    return joined.select("collection", "sample", "item_id", problem.alias("problem"))


def fetch_plan(
    requests: DataFrame,
    items: DataFrame,
    datasets: DataFrame,
    files: DataFrame,
    types: Sequence[str] | None = ("common.fastq",),
    priority: str | None = None,
    group_by_lane: bool = False,
    use_latest: bool = False,
    validate_paired: bool = True,
    validate_lanes: bool = False,
) -> dict[str, DataFrame]:
    """``files`` to fetch per served sample, and one ``results`` row per request.

    ``datasets`` and ``files`` carry the collection's ``item_id`` and the ``dataset_id``. Large inputs are
    planned when this is called, in rounds of collections, so that only a part of them is shuffled at a time.
    """
    choices = (types, group_by_lane, use_latest, validate_paired, validate_lanes)
    resolved = resolve_requests(requests, items, priority)
    listed, results = _planned(resolved, datasets, files, *choices)
    n = rounds_of(datasets, files, most=ROUNDS)
    if n > 1:
        spark = requests.sparkSession
        asked, path = work_path(spark, "resolved"), work_path(spark, "planned")
        put(resolved, asked)
        resolved = spark.read.schema(resolved.schema).parquet(asked)
        for k in range(n):
            mine = hash_class(["item_id"], n) == k
            put(_planned(resolved.filter(mine), datasets.filter(mine), files.filter(mine), *choices)[1], path)
        listed = _planned(resolved, datasets, files, *choices)[0]
        results = spark.read.schema(results.schema).parquet(path)
    group = ["item_id", "sample"]
    fetched = keyed_join(
        listed,
        results.filter(col("status") == "ok").select(*group),
        group,
        "left_semi",
    )
    return {"files": fetched, "results": results}


def _planned(
    resolved: DataFrame,
    datasets: DataFrame,
    files: DataFrame,
    types: Sequence[str] | None,
    group_by_lane: bool,
    use_latest: bool,
    validate_paired: bool,
    validate_lanes: bool,
) -> tuple[DataFrame, DataFrame]:
    """Files of served datasets, and results."""
    good = resolved.filter(col("problem").isNull())
    matched = seqfiles.match_datasets(
        good.select("item_id", "sample"),
        datasets.filter(seqfiles.of_type(types)),
        group_by_lane,
        use_latest,
        scope=["item_id"],
        carry=["is_paired_end"],
    )
    group = ["item_id", "sample"]
    # A dataset can serve two requests (its own name and its bare name), so requests are the many side.
    served = matched.filter(col("dataset_id").isNotNull()).select("item_id", "dataset_id", "sample")
    # Only files of served datasets are counted; the store's other files end at this join.
    listed = files.select("item_id", "dataset_id", "file_id", "file_name", "size").join(
        served, ["item_id", "dataset_id"], "inner"
    )
    judged = matched.select(*group, "status", col("dataset_id").alias("__dataset"), "is_paired_end")
    paired = F.when(col("status").isNotNull(), F.coalesce(col("is_paired_end"), F.lit(False)))
    overview = (
        judged.unionByName(listed.select(*group, "file_name", "size"), allowMissingColumns=True)
        .groupBy(*group)
        .agg(
            F.max("status").alias("status"),
            F.count("__dataset").alias("datasets"),
            F.bool_and(paired).alias("__paired"),
            *seqfiles.read_counts(),
        )
    )
    number = {n: F.coalesce(col(n), F.lit(0)) for n in ("datasets", *COUNTS)}
    balanced = seqfiles.is_balanced(number["r1_files"], number["r2_files"], number["files"])
    status = F.when(col("problem").isNotNull(), col("problem")).when(
        ~col("status").isin("exact", "lanes"), col("status")
    )
    if validate_paired:
        status = status.when(~col("__paired"), "not_paired").when(~balanced, "unbalanced")
    if validate_lanes:
        by_read = seqfiles.files_by_read(listed)
        lanes = seqfiles.lane_naming_check(by_read, [*group, "read"]).select(*group).distinct()
        overview = keyed_join(overview, lanes.withColumn("__lanes_differ", F.lit(True)), group)
        status = status.when(col("__lanes_differ"), "lane_names_differ")
    results = keyed_join(resolved, overview, group).select(
        "collection", "sample", "item_id", status.otherwise("ok").alias("status"), *[v.alias(n) for n, v in number.items()]
    )
    return listed, results
