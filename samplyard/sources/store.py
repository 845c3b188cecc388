"""Writing the samples and configs tables.

Plain parquet has no row-level update, so a keyed update rewrites the partitions it touches and no
others. The new rows are staged in the shared folder first: the table is never both source and
target of a running job, and a failed overwrite can be repeated from the staged copy.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from samplyard.functions.columns import col, cols
from samplyard.operators import update
from samplyard.operators.clean import coerce_types, complete_columns, prune_columns
from samplyard.operators.joins import distinct_keys, keyed_join
from samplyard.schema import SchemaSpec
from samplyard.session import work_path

PARTITION = "created_date"


def create_table(spark: SparkSession, table: str, schema: SchemaSpec, exists_ok: bool = True, partition_from: str | None = None) -> bool:
    """Create an empty table; True when it is new.

    ``partition_from`` names the timestamp whose day becomes the partition column.
    """
    if spark.catalog.tableExists(table):
        if not exists_ok:
            raise ValueError(f"table {table} already exists")
        return False
    empty = spark.createDataFrame([], schema.struct)
    writer = empty.write
    if partition_from:
        writer = empty.withColumn(PARTITION, col(partition_from).cast("date")).write.partitionBy(PARTITION)
    writer.format("parquet").saveAsTable(table)
    return True


def with_partition(df: DataFrame, source: str = "created_at") -> DataFrame:
    return df.withColumn(PARTITION, col(source).cast("date"))


def append_rows(df: DataFrame, path: str, mode: str = "append", partitioned: bool = True) -> None:
    """Append cleaned rows, by creation day.

    A day is spread over several files by the primary columns' hash only as far as adaptive
    execution sees fit, so a day that holds most rows is not written by one task.
    """
    if partitioned:
        dated = df if PARTITION in df.columns else with_partition(df)
        dated.hint("rebalance", PARTITION).write.mode(mode).partitionBy(PARTITION).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def insert_rows(spark: SparkSession, rows: list[Mapping[str, Any]], schema: SchemaSpec, path: str) -> None:
    """Append a few literal rows; the types come from the schema, not from the values."""
    lines = spark.createDataFrame([(json.dumps(dict(r), default=str),) for r in rows], "value string")
    nested = {f.name: f.data_type.simpleString() for f in schema.fields if f.kind in ("record", "array")}
    fields = ", ".join(f"`{n}` {nested.get(n, 'string')}" for n in schema.names)
    parsed = lines.select(F.from_json("value", fields).alias("row")).select("row.*")
    append_rows(coerce_types(parsed, schema), path, partitioned="created_at" in schema.names)


def load_samples(df: DataFrame, cleaned_by, path: str, mode: str = "append") -> dict[str, int]:
    """Clean and append in one job; counts come from observations, not from a second pass.

    ``cleaned_by`` maps the raw frame to cleaned rows and reads it once.
    """
    seen, kept = Observation(), Observation()
    raw = df.observe(seen, F.count(F.lit(1)).alias("n"))
    clean = cleaned_by(raw).observe(kept, F.count(F.lit(1)).alias("n"))
    append_rows(clean, path, mode, partitioned="created_at" in clean.columns)
    loaded = kept.get["n"]
    return {"loaded": loaded, "filtered": seen.get["n"] - loaded}


def rewrite_touched(spark: SparkSession, path: str, ids: DataFrame, change, key: str = "id") -> None:
    """Apply ``change`` (DataFrame -> DataFrame) to the partitions that hold any of the ids."""
    table = spark.read.parquet(path)
    hit = keyed_join(table.select(col(key), col(PARTITION)), ids.select(col(key)).distinct(), key, "left_semi")
    days = hit.select(col(PARTITION).alias("__day")).distinct()
    # Rows without a creation day are a folder of their own, and equal to each other here.
    touched = table.join(days, table[PARTITION].eqNullSafe(days["__day"]), "left_semi").select(*cols(table.columns))
    staged = work_path(spark, "update")
    change(touched).hint("rebalance", PARTITION).write.partitionBy(PARTITION).parquet(staged)
    (
        spark.read.schema(table.schema)
        .parquet(staged)
        .hint("rebalance", PARTITION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(path)
    )


def update_rows(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    schema: SchemaSpec,
    as_of=None,
    key: str = "id",
    fields: Sequence[str] | None = None,
    allow_nulls: bool = False,
    batch_size: int = 1000,
) -> DataFrame:
    """Apply change records to the stored table; returns records applied, unmatched and rejected.

    Only days that hold an updated row are rewritten, rows without a day included. The creation
    time decides where a row is stored, so no record may change it. ``updates`` is read more than
    once and should be a stored table or a plain function of one.
    """
    fields = [n for n in (fields or schema.names) if n not in (key, "created_at")]
    ids = distinct_keys(updates, [key])
    rewrite_touched(
        spark, path, ids,
        lambda rows: update.apply_records(rows, updates, schema, as_of, key, fields, allow_nulls, batch_size),
        key,
    )
    return update.accounting(spark.read.parquet(path), updates, schema, key, allow_nulls, batch_size)


def conform(df: DataFrame, schema: SchemaSpec) -> DataFrame:
    """Declared columns only, all of them, in order and typed."""
    full = prune_columns(complete_columns(df, schema), schema)
    return coerce_types(full.select(*cols(schema.names)), schema)
