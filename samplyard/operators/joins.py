"""Joins of a large table with a side that holds one row per key.

Two things make a plain equi-join fragile at scale: rows with a null key all hash to one task,
and a hot key does too. Adaptive execution splits a hot key, but only when both join inputs read
straight from a shuffle made for the join; a de-duplicated side is already partitioned by the key
and blocks that. Joining on ``(hash of the key, key)`` cures both: the hash column forces the
join's own shuffle on either side, and null keys get a row-dependent hash, so they spread out.
The hash is a plain function of the row, so a repeated task sends every row to the same place.
Whether a side is broadcast is left to Spark, which decides by the measured size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samplyard.functions.columns import col, cols

HASH = "__key_hash"


def spread_columns(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """The columns that tell rows with a null key, or with one hot key, apart: all scalar ones.

    A few of them would not do: the times of one load are equal in all its rows, and which column
    differs is not known here.
    """
    scalar = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType, T.BooleanType)
    others = [f.name for f in df.schema.fields if f.name not in keys and isinstance(f.dataType, scalar)]
    return [*keys, *others]


def _with_hash(df: DataFrame, keys: Sequence[str], spread_nulls: bool) -> DataFrame:
    digest: Column = F.xxhash64(*cols(keys))
    if spread_nulls:
        missing = F.lit(False)
        for key in keys:
            missing = missing | col(key).isNull()
        digest = F.when(missing, F.xxhash64(*cols(spread_columns(df, keys)))).otherwise(digest)
    return df.withColumn(HASH, digest)


def keyed_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str] | str, how: str = "left", unique: bool = False
) -> DataFrame:
    """Join on equally named ``keys``; the result keeps the order of the left columns.

    ``right`` should have at most one row per key unless ``how`` is a semi or anti join. ``unique``
    says that ``left`` has so too, and hardly any null keys: there is no hot key to split then, so
    a side that is already partitioned by the keys isn't shuffled again.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if how in ("inner", "left_semi"):
        left = complete(left, keys)
    if unique:
        joined = left.join(right, keys, how)
    else:
        spread = how not in ("inner", "left_semi")
        joined = _with_hash(left, keys, spread).join(_with_hash(right, keys, False), [HASH, *keys], how)
    if how in ("left_anti", "left_semi"):
        return joined.select(*cols(left.columns))
    payload = [name for name in right.columns if name not in keys]
    return joined.select(*cols(left.columns), *cols(payload))


def complete(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in which every key is present."""
    for key in keys:
        df = df.filter(col(key).isNotNull())
    return df


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct complete keys; copies collapse before the shuffle."""
    return complete(df.select(*cols(keys)), keys).distinct()


def without_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is absent from ``right``; incomplete keys stay."""
    return keyed_join(left, distinct_keys(right, keys), keys, "left_anti")


def with_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is present in ``right``."""
    return keyed_join(left, distinct_keys(right, keys), keys, "left_semi")


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = False
) -> DataFrame:
    """One whole row per key: the first (or last) in ``order``.

    An aggregate rather than a window, so each map task sends one row per key and a hot key is
    no single task's work. That is not free: rows with text are combined by sorting, so every map
    task sorts its rows by key, where a window would sort after the shuffle. ``order`` should break
    ties.
    """
    payload = [name for name in df.columns if name not in keys]
    pick = F.max_by if last else F.min_by
    best = pick(F.struct(*cols(payload)), F.struct(*order))
    rows = df.groupBy(*cols(keys)).agg(best.alias("__row"))
    return rows.select(*cols(keys), *[col("__row").getField(name).alias(name) for name in payload])


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, salts: int | None = None
) -> DataFrame:
    """The first ``k`` rows of every key, in two rounds.

    Round one keeps the best ``k`` of each (key, salt) slice, so a hot key is ranked by many
    tasks; round two ranks at most ``k * salts`` survivors per key. There are as many salts as
    shuffle partitions unless ``salts`` says otherwise.
    """
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*cols(spread_columns(df, keys))), F.lit(salts))
    sliced = df.withColumn("__salt", salt)
    by_slice = Window.partitionBy(*cols(keys), F.col("__salt")).orderBy(*order)
    by_key = Window.partitionBy(*cols(keys)).orderBy(*order)
    return (
        sliced.withColumn("__rank", F.row_number().over(by_slice))
        .filter(F.col("__rank") <= k)
        .withColumn("__rank", F.row_number().over(by_key))
        .filter(F.col("__rank") <= k)
        .drop("__salt", "__rank")
    )
