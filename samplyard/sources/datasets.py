"""Search items, datasets and dataset files of the sequencing store."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplyard.functions.columns import col
from samplyard.functions.dates import parse_utc

SEARCH_ITEM = (
    "struct<Type:string, Run:struct<Id:string, Name:string, ExperimentName:string>, "
    "Project:struct<Id:string, Name:string>>"
)
DATASET = (
    "struct<Id:string, Name:string, DateCreated:string, "
    "DatasetType:struct<Id:string, ConformsToIds:array<string>>, "
    "Attributes:struct<common_fastq:struct<IsPairedEnd:boolean, MaxLengthRead1:bigint, "
    "MaxLengthRead2:bigint, TotalClustersPF:bigint, TotalClustersRaw:bigint, TotalReadsPF:bigint, "
    "TotalReadsRaw:bigint>>>"
)
FILE = "struct<Id:string, Name:string, Size:bigint>"


def page_of(item: str) -> str:
    """JSON layout of one result page of such items."""
    return f"struct<Items:array<{item}>, Paging:struct<Offset:bigint, Limit:bigint, DisplayedCount:bigint, TotalCount:bigint>>"


def parse_page(pages: DataFrame, item: str, column: str = "value") -> DataFrame:
    """Items of landed result pages, one row each, as column ``item``; other columns stay."""
    rest = [col(n) for n in pages.columns if n != column]
    return pages.select(*rest, F.explode(F.from_json(col(column), page_of(item))["Items"]).alias("item"))


def parse_search_items(items: DataFrame, column: str = "value") -> DataFrame:
    """(type, id, name, experiment_name, raw): runs, projects, and ``other`` with its raw text."""
    parsed = items.select(col(column).alias("raw"), F.from_json(col(column), SEARCH_ITEM).alias("item"))
    declared = F.lower(F.coalesce(col("item")["Type"], F.lit("")))
    kind = (
        F.when(col("item")["Project"].isNotNull() & (declared == "project"), "project")
        .when(col("item")["Run"].isNotNull() & (declared == "run"), "run")
        .otherwise("other")
    )
    typed = parsed.withColumn("type", kind)

    def by_type(name: str) -> Column:
        return F.when(col("type") == "run", col("item")["Run"][name]).when(
            col("type") == "project", col("item")["Project"][name]
        )

    return typed.select(
        "type",
        by_type("Id").alias("id"),
        by_type("Name").alias("name"),
        F.when(col("type") == "run", col("item")["Run"]["ExperimentName"]).alias("experiment_name"),
        F.when(col("type") == "other", col("raw")).alias("raw"),
    )


def collection_items(search_items: DataFrame) -> DataFrame:
    """(scope, name, item_id): runs go by experiment name, projects by name."""
    is_run = col("type") == "run"
    return search_items.filter(col("type").isin("run", "project")).select(
        F.when(is_run, "runs").otherwise("projects").alias("scope"),
        F.when(is_run, col("experiment_name")).otherwise(col("name")).alias("name"),
        col("id").alias("item_id"),
    )


def flatten_datasets(parsed: DataFrame, column: str = "item") -> DataFrame:
    """Flat dataset rows; other columns stay. Dates keep microseconds, in UTC."""
    item, fastq = col(column), col(column)["Attributes"]["common_fastq"]
    rest = [col(n) for n in parsed.columns if n != column]
    return parsed.select(
        *rest,
        item["Id"].alias("dataset_id"),
        item["Name"].alias("name"),
        parse_utc(item["DateCreated"]).alias("date_created"),
        item["DatasetType"]["Id"].alias("type_id"),
        F.when(
            item["DatasetType"].isNotNull(),
            F.coalesce(item["DatasetType"]["ConformsToIds"], F.array().cast("array<string>")),
        ).alias("conforms_to"),
        fastq["IsPairedEnd"].alias("is_paired_end"),
        fastq["MaxLengthRead1"].alias("max_length_read1"),
        fastq["MaxLengthRead2"].alias("max_length_read2"),
        fastq["TotalClustersPF"].alias("total_clusters_pf"),
        fastq["TotalClustersRaw"].alias("total_clusters_raw"),
        fastq["TotalReadsPF"].alias("total_reads_pf"),
        fastq["TotalReadsRaw"].alias("total_reads_raw"),
    )


def parse_datasets(text: DataFrame, column: str = "value") -> DataFrame:
    """Datasets from one JSON object per row."""
    rest = [col(n) for n in text.columns if n != column]
    return flatten_datasets(text.select(*rest, F.from_json(col(column), DATASET).alias("item")))


def flatten_files(parsed: DataFrame, column: str = "item") -> DataFrame:
    rest = [col(n) for n in parsed.columns if n != column]
    item = col(column)
    return parsed.select(
        *rest, item["Id"].alias("file_id"), item["Name"].alias("file_name"), item["Size"].alias("size")
    )


def union_scopes(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
