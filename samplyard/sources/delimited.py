"""Delimited text tables."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samplyard.functions.columns import col, cols
from samplyard.operators.search import extract_columns, row_search

# Texts that stand for a missing value in a delimited table.
NA_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def na_to_null(value: Column) -> Column:
    return F.when(~value.isin(*NA_TEXTS), value)


def _text_options(separator: str) -> dict[str, str]:
    return {"sep": separator, "header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


def read_entity_table(spark: SparkSession, path: str, separator: str = "\t", columns: Sequence[str] | None = None, multiline: bool = False) -> DataFrame:
    """Header row, every column as text, missing-value texts as null.

    Only the header is looked at up front. ``columns`` prunes the scan and always keeps the first
    column, the id. Files are split between tasks unless cells hold line breaks (``multiline``).
    """
    df = spark.read.options(**_text_options(separator), inferSchema="false", multiLine=str(multiline).lower()).csv(path)
    names = df.columns
    if columns is not None:
        wanted = set(columns)
        names = [n for i, n in enumerate(names) if i == 0 or n in wanted]
    return df.select(*[na_to_null(col(n)).alias(n) for n in names])


def read_upload(spark: SparkSession, path: str, table: str | None = None) -> tuple[str, DataFrame]:
    """An upload file and the table name it stands for: the file stem unless one is given.

    ``.tsv`` is tab-separated, anything else comma-separated; column types are inferred.
    """
    file = PurePosixPath(path)
    separator = "\t" if file.suffix == ".tsv" else ","
    df = spark.read.options(**_text_options(separator), inferSchema="true").csv(path)
    return table or file.stem, df


def write_entity_table(df: DataFrame, path: str, separator: str = "\t", mode: str = "errorifexists") -> None:
    """Text files with a header; nulls are empty cells."""
    options = _text_options(separator) | {"emptyValue": "", "nullValue": ""}
    df.write.mode(mode).options(**options).csv(path)


def publish_entity_table(df: DataFrame, path: str, separator: str = "\t", mode: str = "errorifexists") -> None:
    """:func:`write_entity_table` for tables that others read: one without rows is refused unwritten."""
    if df.isEmpty():
        raise ValueError(f"nothing to publish to {path}")
    write_entity_table(df, path, separator, mode)


def write_partitioned_sheet(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> None:
    """One folder of comma-separated sheets per collection."""
    options = _text_options(",") | {"emptyValue": "", "nullValue": ""}
    df.write.mode(mode).partitionBy(*by).options(**options).csv(path)


def export_table(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, columns_searched: Sequence[str] | None = None, **search
) -> None:
    """Search, pick columns, write tab-separated text; ``columns`` are those written, by default all."""
    found = row_search(df, columns=columns_searched, **search)
    picked = extract_columns(found, columns, df.columns[0]) if columns else found
    write_entity_table(picked.select(*cols(picked.columns)), path)
