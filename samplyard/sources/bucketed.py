"""The samples table in hash buckets of its id, so that keyed writes do not shuffle it.

The table is partitioned by creation day and every day is dealt into the same buckets, sorted by id. A join by
id reads the table bucket by bucket where it lies and shuffles the change side alone, whatever the
share of the two. Written back are only the days that hold a changed row, each task its bucket.

A write reads the days it replaces: rows go to a staging folder of the job and take their place when all
tasks are done, so a failed job leaves the table as it was. Run one writer per table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samplyard.functions.columns import col, cols
from samplyard.operators import update
from samplyard.operators.clean import moment
from samplyard.operators.joins import complete, distinct_keys, first_per_key
from samplyard.schema import SchemaSpec
from samplyard.sources.store import PARTITION, with_partition


def create_bucketed(
    spark: SparkSession, table: str, schema: SchemaSpec, buckets: int, path: str | None = None, key: str = "id", exists_ok: bool = True
) -> bool:
    """Create an empty table; True when it is new. ``path`` makes it one outside the warehouse.

    Choose ``buckets`` so that a bucket of all days looked at fits a task; the count stays.
    """
    if spark.catalog.tableExists(table):
        if not exists_ok:
            raise ValueError(f"table {table} already exists")
        return False
    if key not in schema.names or "created_at" not in schema.names:
        raise ValueError(f"a bucketed table needs {key} and created_at")
    # As an option of the table, every overwrite of it replaces the days written and no others.
    empty = with_partition(spark.createDataFrame([], schema.struct))
    writer = empty.write.partitionBy(PARTITION).option("partitionOverwriteMode", "dynamic")
    if path:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)
    return True


def bucket_count(spark: SparkSession, table: str) -> int:
    """Buckets of a table, as its catalog entry has them; an error when it has none."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Num Buckets'").collect()
    if not described:
        raise ValueError(f"table {table} has no buckets")
    return int(described[0]["data_type"])


def append_bucketed(df: DataFrame, table: str, key: str = "id") -> None:
    """Append cleaned rows: one shuffle deals them to the buckets, a file per bucket and day.

    Rows are matched to the table by name; a column that one of the two lacks is an error, and so is a
    value of another kind.
    """
    spark = df.sparkSession
    stored = spark.table(table)
    dated = df if PARTITION in df.columns else with_partition(df)
    lacking, unknown = set(stored.columns) - set(dated.columns), set(dated.columns) - set(stored.columns)
    if lacking or unknown:
        raise ValueError(f"columns differ from {table}: without {sorted(lacking)}, unknown {sorted(unknown)}")
    dealt(dated.select(*cols(stored.columns)), bucket_count(spark, table), key).write.insertInto(table)


def settled_values(rows: DataFrame, values: Mapping[str, Column], key: str = "id") -> DataFrame:
    """One row per id with the value of each field; of several rows of an id, the least values count."""
    fields = {n: F.struct(v.cast("string").alias("value")).alias(f"new_{n}") for n, v in values.items()}
    side = complete(rows, [key]).select(col(key), *fields.values())
    return first_per_key(side, [key], [col(f"new_{n}") for n in values])


def dealt(settled: DataFrame, buckets: int, key: str = "id") -> DataFrame:
    """The change side in as many parts as the table has, so that no join shuffles the table instead."""
    return settled.repartition(buckets, col(key))


def changed_rows(table: DataFrame, settled: DataFrame, schema: SchemaSpec, as_of=None, key: str = "id") -> DataFrame:
    """The table with dealt rows written; buckets of the table stay where they are."""
    return update.apply_settled(table, settled, schema, as_of, key)


def touched_days(table: DataFrame, settled: DataFrame, key: str = "id") -> list:
    """Days that hold a row to change, None for rows without one: no more than the table has."""
    hits = table.select(col(key), col(PARTITION)).join(settled.select(col(key)), key, "left_semi")
    return [r[0] for r in hits.select(PARTITION).distinct().collect()]


def of_days(table: DataFrame, days: Sequence) -> DataFrame:
    """Rows of the given days, None included; other folders are not opened."""
    wanted = col(PARTITION).isin([d for d in days if d is not None])
    return table.filter(wanted | col(PARTITION).isNull() if None in days else wanted)


def write_settled(spark: SparkSession, table: str, settled: DataFrame, schema: SchemaSpec, as_of=None, key: str = "id") -> int:
    """Write settled rows into the table; returns how many days were rewritten.

    ``settled`` has one row per id and a ``struct(value)`` named ``new_<field>`` per field; it is read
    twice. The creation time decides where a row is stored, so it can't be written.
    """
    if "new_created_at" in settled.columns or f"new_{key}" in settled.columns:
        raise ValueError(f"{key} and created_at decide where a row is stored")
    stored, settled = spark.table(table), dealt(settled, bucket_count(spark, table), key)
    days = touched_days(stored, settled, key)
    if days:
        rows = changed_rows(of_days(stored, days), settled, schema, moment(as_of), key)
        rows.select(*cols(stored.columns)).write.insertInto(table, overwrite=True)
    return len(days)


def update_bucketed(
    spark: SparkSession,
    table: str,
    updates: DataFrame,
    schema: SchemaSpec,
    as_of=None,
    key: str = "id",
    fields: Sequence[str] | None = None,
    allow_nulls: bool = False,
    batch_size: int = 1000,
) -> DataFrame:
    """Apply change records to the table; returns records applied, unmatched and rejected per batch."""
    fields = [n for n in (fields or schema.names) if n not in (key, "created_at")]
    checked = update.check_records(updates, schema, allow_nulls)
    write_settled(spark, table, update.settle_records(checked, fields, key, batch_size, allow_nulls), schema, as_of, key)
    return update.accounting(spark.table(table), updates, schema, key, allow_nulls, batch_size)


def mark_uploaded(spark: SparkSession, table: str, ids: DataFrame, upload_source: str, schema: SchemaSpec, as_of=None) -> int:
    now = moment(as_of)
    values = {"uploaded_at": now, "upload_source": F.lit(upload_source)}
    return write_settled(spark, table, settled_values(distinct_keys(ids, ["id"]), values), schema, as_of)


def mark_submitted(
    spark: SparkSession, table: str, ids: DataFrame, schema: SchemaSpec, as_of=None, submission: str = "submission_id", state: str = "workflow_state"
) -> int:
    """``ids`` brings the submission id of every sample."""
    values = {"submitted_at": moment(as_of), submission: col(submission), state: F.lit("Submitted")}
    return write_settled(spark, table, settled_values(ids, values), schema, as_of)


def apply_sync(spark: SparkSession, table: str, changes: DataFrame, schema: SchemaSpec, as_of=None) -> int:
    """Write the changes of a sync run; of several rows of an id, the first by identifier counts."""
    settled = first_per_key(complete(changes, ["id"]), ["id"], [col(schema.identifier)])
    return write_settled(spark, table, settled, schema, as_of)


def apply_refresh(spark: SparkSession, table: str, refreshed: DataFrame, schema: SchemaSpec, as_of=None) -> int:
    """Write workflow ids and states of a status refresh."""
    values = {n: col(n) for n in ("workflow_id", "workflow_state")}
    return write_settled(spark, table, settled_values(refreshed, values), schema, as_of)
