"""Large jobs in rounds: each takes the keys of one hash class, and what it shuffled goes before the next begins."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samplyard.functions.columns import cols

#: Bytes of input files for one round, and the most rounds.
ROUND_BYTES, MOST = 64 << 20, 8
#: Sizes beyond are Spark's default for what it knows nothing of.
UNKNOWN = 1 << 62
#: Spark's setting for dropping the shuffle files of a statement when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's setting for the files a task keeps open, so that it need not sort rows by folder first.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


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


def input_bytes(*frames: DataFrame) -> int:
    """Bytes of what the frames read, as Spark knows them; rows that are in no file count as none. No job runs."""
    total = 0
    for df in frames:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
        total += sum(size for size in sizes if size < UNKNOWN)
    return total


def rounds_of(*frames: DataFrame, most: int = MOST) -> int:
    """Rounds for jobs over the frames: one for small ones, ``most`` for large ones."""
    return min(-(-input_bytes(*frames) // ROUND_BYTES) or 1, most)


def hash_class(keys: list[str], classes: int) -> Column:
    return F.pmod(F.xxhash64(*cols(keys)), F.lit(classes)).cast("int")


def put(df: DataFrame, path: str) -> None:
    """Add the rows to a staged table. What the statement shuffled is freed with it, as nothing reads those files again."""
    with settings(df.sparkSession, {FREE_SHUFFLES: "true"}):
        df.write.mode("append").option("compression", "zstd").parquet(path)
