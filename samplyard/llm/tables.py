"""Inputs, staged tables and Arrow batches shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplyard.session import remove_folder, work_path

#: Text bytes handled at once inside a task.
PIECE_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting for dropping the shuffle files of a statement when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Spark's setting for the bytes of an Arrow batch, and how many a task's Python gets at once. Batches are
#: held twice, by the JVM outside its heap and by Python, so those of 10,000 whole texts take much memory.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings for the statements inside; afterwards they are as before."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def staged(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """The rows, written to the shared folder (or to ``folder`` in it) and read again: lineage ends here.

    What the write shuffled is freed with it, as nothing reads those files again.
    """
    spark = df.sparkSession
    path = f"{folder}/{label}" if folder else work_path(spark, label)
    with settings(spark, {FREE_SHUFFLES: "true", BATCH: f"{BATCH_BYTES}b"}):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, folder: str, *labels: str) -> None:
    """Delete tables staged in a folder, or all of it, once nothing that is still to run reads them."""
    for path in [f"{folder}/{label}" for label in labels] or [folder]:
        remove_folder(spark, path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts_of(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id``, the given columns and the text with null as empty; other columns are left out."""
    return docs.select("doc_id", *columns, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a non-null string column, and where each row starts and the last one ends."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    buffers = column.buffers()
    ends = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if buffers[2] is None:
        return np.zeros(0, np.uint8), ends - (ends[0] if len(ends) else 0)
    return np.frombuffer(buffers[2], np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def pieces(batches: Iterator[pa.RecordBatch], limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the ``text`` of each takes about ``limit`` bytes, one row at least.

    At the end, memory that Arrow holds without use goes back: workers stay for later tasks.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        _, ends = text_buffer(batch.column("text"))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + limit, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop
    pa.default_memory_pool().release_unused()
