"""Positions and running totals inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplyard.functions.columns import col, cols
from samplyard.operators.joins import complete
from samplyard.operators.rounds import FREE_SHUFFLES, WRITERS, hash_class, put, rounds_of, settings
from samplyard.session import list_folders, remove_folder, work_path

#: Bins of groups, and the rows of a bin that one task may order.
BINS, HOT_ROWS = 1 << 16, 200_000
ROUND = "__round"


def _amount(name: str) -> Column:
    return F.coalesce(col(name).cast("bigint"), F.lit(0))


def _numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str) -> DataFrame:
    per_key = Window.partitionBy(*cols(keys)).orderBy(*cols(order))
    before = F.sum(_amount(amount)).over(per_key.rowsBetween(Window.unboundedPreceding, -1))
    return df.select(
        "*",
        F.row_number().over(per_key).cast("bigint").alias("__position"),
        F.coalesce(before, F.lit(0)).alias("__offset"),
    )


def running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, slices: int | None = None
) -> DataFrame:
    """Adds ``position`` (from 1) and ``offset`` (sum of ``amount`` before the row) per key; own columns
    of these names are replaced.

    ``order`` must be a total order. The rows are written to the shared folder first, so ``df`` is computed
    once, when the plan is built. Groups share bins by a hash of their key; those of bins up to ``HOT_ROWS``
    rows are numbered by one shuffle, in rounds when the input is large: a round's rows, once numbered, are
    written and its staged ones and shuffle files go. Groups of larger bins are cut into ranges, see
    :func:`_ranged`. Rows without a complete key drop out.
    """
    spark = df.sparkSession
    rounds, rows = rounds_of(df), work_path(spark, "rows")
    df = complete(df, keys)
    written, fields = df.columns, df.schema
    names = [n for n in written if n not in ("position", "offset")]
    with settings(spark, {FREE_SHUFFLES: "true", WRITERS: str(2 * rounds)}):
        writer = df.withColumn(ROUND, hash_class(keys, rounds)).write.option("compression", "zstd")
        writer.partitionBy(ROUND).parquet(rows)

    def staged(*folders: str) -> DataFrame:
        return spark.read.schema(fields).parquet(*folders) if folders else spark.createDataFrame([], fields)

    def numbered(part: DataFrame) -> DataFrame:
        found = _numbered(part, keys, order, amount)
        return found.select(*cols(names), col("__position").alias("position"), col("__offset").alias("offset"))

    folders = [f"{rows}/{n}" for n in list_folders(spark, rows)]
    bin_ = hash_class(keys, BINS)
    sizes = staged(*folders).groupBy(bin_.alias("bin")).count().filter(col("count") > HOT_ROWS)
    hot = [r["bin"] for r in sizes.collect()]
    small = (lambda part: part.filter(~bin_.isin(hot))) if hot else (lambda part: part)
    if rounds == 1:
        out = numbered(small(staged(*folders)))
    else:
        path = work_path(spark, "numbered")
        for folder in folders:
            put(numbered(small(staged(folder))), path)
            if not hot:
                remove_folder(spark, folder)
        out = spark.read.schema(numbered(staged()).schema).parquet(path) if folders else numbered(staged())
    if not hot:
        return out
    return out.unionByName(_ranged(staged(*folders).filter(bin_.isin(hot)), keys, order, amount, names, slices))


def _ranged(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, names: Sequence[str], slices: int | None
) -> DataFrame:
    """Rows are cut into ranges of (key, order), each range is numbered on its own, and the totals of the
    ranges, a handful of rows per key, supply where each range starts.

    The ranges are staged before they are used twice.
    """
    spark = df.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = work_path(spark, "ranges")
    put(df.repartitionByRange(slices, *cols(keys), *cols(order)).withColumn("__slice", F.spark_partition_id()), staged)
    ranges = spark.read.parquet(staged)
    numbered = _numbered(ranges, [*keys, "__slice"], order, amount)
    earlier = Window.partitionBy(*cols(keys)).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranges.groupBy(*cols(keys), "__slice").agg(
        F.count(F.lit(1)).alias("__count"), F.sum(_amount(amount)).alias("__sum")
    )
    starts = totals.select(
        *cols(keys),
        "__slice",
        F.coalesce(F.sum("__count").over(earlier), F.lit(0)).alias("__rows_before"),
        F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__sum_before"),
    )
    # No (key, range) is larger than a range, so the numbered rows stay where they are for the join.
    return numbered.join(starts, [*keys, "__slice"]).select(
        *cols(names),
        (col("__rows_before") + col("__position")).alias("position"),
        (col("__sum_before") + col("__offset")).alias("offset"),
    )
