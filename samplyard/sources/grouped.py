"""Samples stored by config group and day, so that a look-back opens the folders of active configs only.

A config group is a hash bucket of the config. The active configs choose the groups while the query runs
(dynamic partition pruning), the look-back chooses the days; no other folder is opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samplyard.functions.columns import col
from samplyard.operators import lookup
from samplyard.session import list_folders
from samplyard.sources.store import PARTITION, with_partition

GROUP = "config_group"
FOLDER = "groups_"


def config_group(config: Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(config), F.lit(groups)).cast("int")


def group_count(spark: SparkSession, path: str) -> int | None:
    """Groups of a stored table, as its folder tells; None where there is none yet."""
    found = [n for n in list_folders(spark, path) if n.startswith(FOLDER)]
    return int(found[0].removeprefix(FOLDER)) if found else None


def append_grouped(df: DataFrame, path: str, groups: int = 64, config_key: str = "config_id") -> None:
    """Append samples by config group and creation day; the number of groups of a table stays."""
    there = group_count(df.sparkSession, path)
    if there not in (None, groups):
        raise ValueError(f"{path} has {there} groups, not {groups}")
    rows = with_partition(df).withColumn(GROUP, config_group(col(config_key), groups))
    spread = rows.hint("rebalance", GROUP, PARTITION)
    spread.write.mode("append").partitionBy(GROUP, PARTITION).parquet(f"{path.rstrip('/')}/{FOLDER}{groups}")


def read_grouped(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The stored samples and their number of groups."""
    groups = group_count(spark, path)
    if groups is None:
        raise ValueError(f"no grouped table in {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{FOLDER}{groups}"), groups


def of_active_configs(samples: DataFrame, groups: int, configs: DataFrame, config_key: str = "config_id") -> DataFrame:
    """Samples of active configs. The groups to open come from the configs as the query runs, provided Spark
    finds these small enough to broadcast; otherwise all groups are read and the join decides."""
    # Compared as text: a bare flag isn't taken for a filter worth pruning by.
    active = configs.filter(col("active").cast("string") == "true").select(col("id").cast("string").alias(config_key))
    chosen = active.withColumn(GROUP, config_group(col(config_key), groups))
    return samples.join(chosen, [GROUP, config_key], "left_semi").select(*[col(n) for n in samples.columns])


def incomplete_of_active(
    samples: DataFrame, groups: int, configs: DataFrame, as_of=None, days_back: int = 30, limit: int | None = None, config_key: str = "config_id"
) -> DataFrame:
    """Unfinished workflows of active configs inside the look-back; see :func:`lookup.incomplete_workflows`."""
    ours = of_active_configs(samples, groups, configs, config_key)
    return lookup.incomplete_workflows(ours, as_of, days_back, limit, config_key=config_key)
