"""Sequencing datasets and their files: matching, checking, grouping by lane and read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplyard.functions.columns import col, cols
from samplyard.functions.names import is_read, megabyte_text, strip_lane, trimmed
from samplyard.operators.joins import distinct_keys, keyed_join, with_keys
from samplyard.operators.ordering import running_totals


def of_type(types: Sequence[str] | None, type_id: str = "type_id", conforms: str = "conforms_to") -> Column:
    """Dataset type is listed, or it conforms to a listed one. None keeps all, [] keeps none."""
    if types is None:
        return F.lit(True)
    if not types:
        return F.lit(False)
    listed = F.array(*[F.lit(t) for t in types])
    return col(type_id).isNotNull() & (
        col(type_id).isin(*types) | F.coalesce(F.arrays_overlap(col(conforms), listed), F.lit(False))
    )


def resolve_names(requests: DataFrame, items: DataFrame, priority: str | None = None, name: str = "name") -> DataFrame:
    """One row per requested collection name: (name, status, scope, item_id).

    ``items`` has (scope, name, item_id) with scope ``runs`` or ``projects``. A name found in
    both scopes needs a priority; more than one hit in the chosen scope cannot be resolved.
    """
    return with_resolved(requests.select(trimmed(col(name)).alias(name)).distinct(), items, priority, name)


def with_resolved(wanted: DataFrame, items: DataFrame, priority: str | None = None, name: str = "name") -> DataFrame:
    """Every row of ``wanted`` with the status, scope and item of its collection name."""
    def of_scope(scope: str) -> list[Column]:
        here = col("scope") == scope
        return [
            F.count_if(here).alias(f"__{scope}"),
            F.min(F.when(here, col("item_id"))).alias(f"__{scope}_id"),
        ]

    hits = items.filter(col(name).isNotNull()).groupBy(col(name)).agg(*of_scope("runs"), *of_scope("projects"))
    found = keyed_join(wanted, hits, name)
    runs, projects = F.coalesce(col("__runs"), F.lit(0)), F.coalesce(col("__projects"), F.lit(0))
    order = ("projects", "runs") if priority == "projects" else ("runs", "projects")
    scope = F.when((runs if order[0] == "runs" else projects) > 0, order[0]).when(
        (runs if order[1] == "runs" else projects) > 0, order[1]
    )
    hits_in_scope = F.when(scope == "runs", runs).otherwise(projects)
    both = (runs > 0) & (projects > 0) & F.lit(priority is None)
    status = (
        F.when(scope.isNull(), "missing")
        .when(both, "ambiguous_scope")
        .when(hits_in_scope > 1, "duplicate")
        .otherwise("resolved")
    )
    kept = cols(wanted.columns)
    return found.select(*kept, status.alias("status"), scope.alias("__scope"), "__runs_id", "__projects_id").select(
        *kept,
        "status",
        F.when(col("status") == "resolved", col("__scope")).alias("scope"),
        F.when(
            col("status") == "resolved",
            F.when(col("__scope") == "runs", col("__runs_id")).otherwise(col("__projects_id")),
        ).alias("item_id"),
    )


def duplicate_names(df: DataFrame, name: str = "name") -> DataFrame:
    """Names carried by more than one row."""
    return df.groupBy(col(name)).agg(F.count(F.lit(1)).alias("copies")).filter(col("copies") > 1)


def latest_per_name(datasets: DataFrame, keys: Sequence[str], payload: Sequence[str] = ("dataset_id",), created: str = "date_created") -> DataFrame:
    """Newest dataset per key: payload, copies, and whether the newest date is shared.

    Equal dates collapse first, then the newest date of a key wins; both steps combine on the
    map side.
    """
    row = F.struct(*cols(payload))
    same_date = datasets.groupBy(*cols(keys), col(created)).agg(
        F.count(F.lit(1)).alias("__n"), F.min(row).alias("__row")
    )
    newest = same_date.groupBy(*cols(keys)).agg(
        F.max_by(F.struct(col("__n"), col("__row"), col(created)), col(created)).alias("__top"),
        F.sum("__n").alias("copies"),
    )
    top = col("__top")
    return newest.select(
        *cols(keys),
        top[created].alias(created),
        *[top["__row"][name].alias(name) for name in payload],
        col("copies"),
        (top["__n"] > 1).alias("tie"),
    )


def match_datasets(
    requests: DataFrame,
    datasets: DataFrame,
    group_by_lane: bool = False,
    use_latest: bool = False,
    sample: str = "sample",
    scope: Sequence[str] = (),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Datasets of every requested sample: (scope.., sample, status, dataset_id, name, carry..).

    An exact name beats lane siblings; siblings count only when lanes may be grouped. Status is
    ``exact``, ``lanes``, ``partial`` (only siblings, not grouped), ``missing``, ``duplicate``
    (a name with several datasets) or ``tie`` (its newest ones share a date). A sample that
    cannot be served has one row without dataset. ``scope`` columns, such as a collection, must
    agree on both sides.

    A sample is judged in one window over its names and a row that stands for the request. Copies of
    a name are one row by then, and there are only as many names of a sample as there are lane
    tokens, a few thousand at most, so no window holds a hot group.
    """
    keys = [*scope, sample]
    wanted = distinct_keys(requests.select(*cols(scope), trimmed(col(sample)).alias(sample)), keys)
    stripped = strip_lane(col("name"))
    # A dataset offers itself under its own name and, if it has a lane, under the bare name.
    offers = F.array_compact(
        F.array(
            F.struct(col("name").alias(sample), F.lit(0).alias("sibling")),
            F.when(stripped != col("name"), F.struct(stripped.alias(sample), F.lit(1).alias("sibling"))),
        )
    )
    payload = ["dataset_id", *carry]
    offered = datasets.select(*cols(scope), *cols(payload), "name", "date_created", F.inline(offers))
    named = latest_per_name(with_keys(offered, wanted, keys), [*keys, "sibling", "name"], payload)

    per_sample = Window.partitionBy(*cols(keys))

    def any_of(sibling: int, flag: Column) -> Column:
        return F.bool_or(F.when(col("sibling") == sibling, flag)).over(per_sample)

    judged = named.unionByName(wanted, allowMissingColumns=True).withColumns(
        {
            "best": F.min("sibling").over(per_sample),
            "exact_dup": any_of(0, col("copies") > 1),
            "exact_tie": any_of(0, col("tie")),
            "lane_dup": any_of(1, col("copies") > 1),
            "lane_tie": any_of(1, col("tie")),
        }
    )
    exact = col("best") == 0
    dup = F.when(exact, col("exact_dup")).otherwise(col("lane_dup"))
    tie = F.when(exact, col("exact_tie")).otherwise(col("lane_tie"))
    status = F.when(col("best").isNull(), "missing")
    if not group_by_lane:
        status = status.when(~exact, "partial")
    status = status.when(tie, "tie") if use_latest else status.when(dup, "duplicate")
    status = status.when(exact, "exact").otherwise("lanes")
    is_served = col("status").isin("exact", "lanes")
    stands_for_request = col("sibling").isNull()
    rows = judged.withColumn("status", status).filter(
        F.when(is_served, F.coalesce(col("sibling") == col("best"), F.lit(False))).otherwise(stands_for_request)
    )
    return rows.select(*cols(keys), "status", "dataset_id", "name", *cols(carry))


def read_counts() -> list[Column]:
    """Aggregates over files: R1 and R2 counts and bytes, and all files."""
    size = F.coalesce(col("size"), F.lit(0))
    out = [F.count(col("file_name")).alias("files")]
    for side in (1, 2):
        mine = F.coalesce(is_read(col("file_name"), side), F.lit(False))
        out.append(F.count_if(mine).alias(f"r{side}_files"))
        out.append(F.coalesce(F.sum(F.when(mine, size)), F.lit(0)).cast("bigint").alias(f"r{side}_bytes"))
    return out


def is_balanced(r1: Column, r2: Column, files: Column) -> Column:
    return (r1 != 0) & (r1 == r2) & (r1 + r2 == files)


def dataset_sheet(datasets: DataFrame, files: DataFrame) -> DataFrame:
    """One row per dataset (unique by id) with concatenated read sizes and the paired and balanced flags."""
    counts = files.groupBy("dataset_id").agg(*read_counts())
    joined = keyed_join(datasets, counts, "dataset_id", unique=True)
    number = lambda name: F.coalesce(col(name), F.lit(0))
    return joined.select(
        col("name").alias("dataset_name"),
        "dataset_id",
        megabyte_text(number("r1_bytes")).alias("read1_concat_size_mb"),
        megabyte_text(number("r2_bytes")).alias("read2_concat_size_mb"),
        number("files").alias("num_files"),
        F.coalesce(col("type_id"), F.lit("")).alias("dataset_type"),
        F.coalesce(col("is_paired_end"), F.lit(False)).alias("is_paired_end"),
        is_balanced(number("r1_files"), number("r2_files"), number("files")).alias("is_balanced"),
    )


def paired_check(files: DataFrame, group: Sequence[str], paired: str = "is_paired_end") -> DataFrame:
    """Per group: ``ok``, ``not_paired`` or ``unbalanced``."""
    counted = files.groupBy(*cols(group)).agg(
        F.bool_and(F.coalesce(col(paired), F.lit(False))).alias("__paired"), *read_counts()
    )
    status = (
        F.when(~col("__paired"), "not_paired")
        .when(~is_balanced(col("r1_files"), col("r2_files"), col("files")), "unbalanced")
        .otherwise("ok")
    )
    return counted.select(*cols(group), status.alias("status"), "files", "r1_files", "r2_files")


def lane_naming_check(files: DataFrame, group: Sequence[str], name: str = "file_name") -> DataFrame:
    """Groups whose files do not agree once the lane token is removed."""
    return (
        files.select(*cols(group), strip_lane(col(name)).alias("__bare"))
        .distinct()
        .groupBy(*cols(group))
        .agg(F.count(F.lit(1)).alias("bare_names"))
        .filter(col("bare_names") > 1)
    )


def expected_size(files: DataFrame, group: Sequence[str]) -> DataFrame:
    """Sum of the sizes, null when any size is unknown."""
    known = F.count(col("size")) == F.count(F.lit(1))
    return files.groupBy(*cols(group)).agg(
        F.when(known, F.sum(col("size").cast("bigint"))).alias("expected_size"),
        F.count(F.lit(1)).alias("files"),
    )


def files_by_read(files: DataFrame) -> DataFrame:
    """Files with their read side; a name that fits both sides appears under both."""
    sides = F.array(*[F.when(is_read(col("file_name"), side), F.lit(f"R{side}")) for side in (1, 2)])
    # Filtered after the explode: a filter inside the array would not be compiled with the stage.
    return files.select("*", F.explode(sides).alias("read")).filter(col("read").isNotNull())


def read_file_lists(files: DataFrame, group: Sequence[str], tie_break: Sequence[str] = ("file_id",)) -> DataFrame:
    """Files of each (group, read) in file-name order, with position and byte offset."""
    return running_totals(files_by_read(files), [*group, "read"], ["file_name", *tie_break], "size")


def concat_plan(files: DataFrame, sample: str = "sample", tie_break: Sequence[str] = ("file_id",)) -> DataFrame:
    """Where every source file goes in its sample's ``<sample>_R1/R2.fastq.gz``."""
    ordered = read_file_lists(files, [sample], tie_break)
    return ordered.select(
        col(sample),
        "read",
        F.concat(col(sample), F.lit("_"), col("read"), F.lit(".fastq.gz")).alias("output_name"),
        "position",
        "file_name",
        col("size").cast("bigint").alias("size"),
        "offset",
    )
