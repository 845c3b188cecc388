"""Named tables of the catalog: uploads, existence and schema rules, partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from samplyard.functions.columns import col, cols
from samplyard.sources.delimited import na_to_null, read_upload


def refuse_existing(spark: SparkSession, tables: Sequence[str], overwrite: bool) -> None:
    """An error that names all tables that are there already, unless they may be replaced."""
    there = [] if overwrite else [t for t in tables if spark.catalog.tableExists(t)]
    if there:
        raise ValueError(f"tables exist: {', '.join(sorted(there))}")


def save_table(
    df: DataFrame, table: str, overwrite: bool = False, partition_by: Sequence[str] = (), location: str | None = None
) -> None:
    """Write a frame as a table of the catalog; one that exists is refused unless it is to be replaced.

    ``location`` puts its files outside the warehouse. Columns to partition by have to be there.
    """
    refuse_existing(df.sparkSession, [table], overwrite)
    lacking = [n for n in partition_by if n not in df.columns]
    if lacking:
        raise ValueError(f"no such columns to partition by: {', '.join(lacking)}")
    writer = df.write.format("parquet").mode("overwrite" if overwrite else "errorifexists")
    if location:
        writer = writer.option("path", location)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def append_table(df: DataFrame, table: str) -> None:
    """Append rows by column name. Missing and unknown columns and other types are refused before anything is written."""
    stored = df.sparkSession.table(table)
    wanted = {f.name: f.dataType for f in stored.schema.fields}
    given = {f.name: f.dataType for f in df.schema.fields}
    problems = [f"without {n}" for n in wanted if n not in given] + [f"unknown {n}" for n in given if n not in wanted]
    problems += [
        f"{n} is {given[n].simpleString()}, not {kind.simpleString()}"
        for n, kind in wanted.items()
        if n in given and given[n] != kind
    ]
    if problems:
        raise ValueError(f"rows do not fit {table}: {'; '.join(problems)}")
    df.select(*cols(stored.columns)).write.insertInto(table)


def upload_tables(
    spark: SparkSession,
    paths: Sequence[str],
    tables: Sequence[str] | None = None,
    overwrite: bool = False,
    location: str | None = None,
) -> list[str]:
    """Load delimited files into named tables, by default named after the files; returns the names.

    All names are checked before the first file is read: as many as files, each once, and none that
    exists unless it is to be replaced. ``location`` is the folder of the tables' files.
    """
    if tables is not None and len(tables) != len(paths):
        raise ValueError(f"{len(paths)} files but {len(tables)} table names")
    uploads = [read_upload(spark, path, None if tables is None else tables[i]) for i, path in enumerate(paths)]
    names = [name for name, _ in uploads]
    if len(set(names)) < len(names):
        raise ValueError(f"several files for one table: {', '.join(sorted({n for n in names if names.count(n) > 1}))}")
    refuse_existing(spark, names, overwrite)
    for name, df in uploads:
        texts = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
        cells = df.select(*[(na_to_null(col(n)) if n in texts else col(n)).alias(n) for n in df.columns])
        save_table(cells, name, overwrite, location=f"{location.rstrip('/')}/{name}" if location else None)
    return names
