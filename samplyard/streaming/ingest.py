"""Continuous ingest: each micro-batch is cleaned, checked against what is known and appended."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from samplyard.plans.ingest import process_samples
from samplyard.schema import SchemaSpec
from samplyard.streaming.known import IdentifierIndex

BATCH = "ingest_batch"
#: Beside the batches; readers of the table skip names that start so.
INDEX = "_known"


def read_table(spark: SparkSession, path: str, schema: SchemaSpec, before: int | None = None) -> DataFrame:
    """Rows ingested so far, or those of batches before the given one."""
    rows = spark.read.schema(schema.struct.add(BATCH, "long")).parquet(path)
    return rows if before is None else rows.filter(F.col(BATCH) < before)


def start_ingest(
    stream: DataFrame,
    schema: SchemaSpec,
    path: str,
    checkpoint: str,
    available_now: bool = True,
    known: Callable[[], DataFrame] | None = None,
    seed: Callable[[], DataFrame] | None = None,
    per_bucket: int = 1 << 16,
    fan: int = 8,
    **options,
) -> StreamingQuery:
    """Append cleaned rows per micro-batch, exactly once.

    Every batch owns the partition with its number and compares only with earlier ones, so a
    batch that is run again after a failure replaces what it had written. Earlier batches aren't read:
    their identifiers stand in an index beside the rows (:mod:`samplyard.streaming.known`).

    ``seed`` gives rows that were there before the stream: they are read once, into the index.
    ``known`` gives rows that other jobs go on loading; it is read anew for every batch.
    """
    keys = [n for n in (schema.identifier, schema.config_key) if n]

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        folder = f"{path.rstrip('/')}/{BATCH}={number}"
        if not schema.identifier:
            process_samples(batch, schema, **options).write.mode("overwrite").parquet(folder)
            return
        index = IdentifierIndex(spark, f"{path.rstrip('/')}/{INDEX}", keys, per_bucket, fan)
        index.forget_from(number)
        if seed is not None and not index.runs():
            index.add(seed(), -1)
        index.fold(number)
        batch.persist()  # the identifiers choose the buckets before the rows meet them
        try:
            seen = [s for s in (index.known(process_samples(batch, schema, **options), number), known and known()) if s is not None]
            every = reduce(DataFrame.unionByName, [s.select(*keys) for s in seen]) if seen else None
            rows = process_samples(batch, schema, known=every, dedupe_within_batch=True, **options)
            rows.write.mode("overwrite").parquet(folder)
        finally:
            batch.unpersist()
        index.add(spark.read.schema(schema.struct).parquet(folder), number)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
