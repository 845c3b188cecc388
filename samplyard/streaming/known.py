"""A standing index of the identifiers a stream has loaded, in hash buckets.

Every micro-batch adds a run: its identifiers, a folder per bucket. The more identifiers a run has, the more
buckets, so a bucket keeps its size; ``fan`` runs of a level are folded into one of the next, so there are few
runs and an identifier is rewritten once a level. A micro-batch opens the buckets its identifiers
fall in and no others: what it reads follows its own size, not that of what has been loaded.

A run is named after its level, last batch and bucket count. Runs of the running batch or later ones
are ignored and removed, so a batch that is run again sees what it saw before; a fold writes first and
removes then, and seeing identifiers twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samplyard.functions.columns import col, cols
from samplyard.session import is_written, list_folders, remove_folder

BUCKET = "bucket"


class Run(NamedTuple):
    level: int
    batch: int
    buckets: int

    @property
    def name(self) -> str:
        return f"run_{self.level}_{self.batch}_{self.buckets}"


def bucket_of(identifier: str, buckets: int) -> Column:
    """``buckets`` is a power of two, so the bucket among fewer is the rest of this one."""
    return F.pmod(F.xxhash64(col(identifier)), F.lit(buckets)).cast("int")


class IdentifierIndex:
    """``keys``: the identifier, then columns kept beside it. ``per_bucket`` identifiers make a bucket."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], per_bucket: int = 1 << 16, fan: int = 8):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.per_bucket, self.fan = per_bucket, fan

    def runs(self) -> list[Run]:
        names = [n for n in list_folders(self.spark, self.path) if n.startswith("run_")]
        return sorted(Run(*map(int, n.split("_")[1:])) for n in names if is_written(self.spark, f"{self.path}/{n}"))

    def _read(self, run: Run) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{run.name}")

    def _write(self, rows: DataFrame, level: int, batch: int, count: int) -> None:
        buckets = 1 << max(0, (count - 1) // self.per_bucket).bit_length()
        run = Run(level, batch, buckets)
        spread = rows.withColumn(BUCKET, bucket_of(self.keys[0], buckets)).repartition(BUCKET)
        spread.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/{run.name}")

    def forget_from(self, batch: int) -> None:
        """Remove what a failed attempt of this batch, or of a later one, may have left."""
        for run in self.runs():
            if run.batch >= batch:
                remove_folder(self.spark, f"{self.path}/{run.name}")

    def add(self, rows: DataFrame, batch: int) -> None:
        """Index the identifiers of written rows as the run of a batch; rows without one are left out."""
        identified = rows.select(*cols(self.keys)).filter(col(self.keys[0]).isNotNull()).distinct()
        count = identified.count()
        if count:
            self._write(identified, 0, batch, count)

    def fold(self, before: int) -> None:
        """Fold full levels, of runs of earlier batches only."""
        level = 0
        while True:
            every = [r for r in self.runs() if r.batch < before]
            members = [r for r in every if r.level == level]
            if len(members) >= self.fan:
                merged = reduce(DataFrame.unionByName, map(self._read, members)).select(*cols(self.keys)).distinct()
                self._write(merged, level + 1, members[-1].batch, merged.count())
                for run in members:
                    remove_folder(self.spark, f"{self.path}/{run.name}")
            elif all(r.level <= level for r in every):
                return
            level += 1

    def scans(self, identifiers: DataFrame, before: int) -> list[DataFrame]:
        """For each run of earlier batches, the buckets that the identifiers fall in.

        The bucket numbers, no more than there are buckets, are the only thing that reaches the driver.
        """
        runs = [r for r in self.runs() if r.batch < before]
        most = max((r.buckets for r in runs), default=1)
        touched = set()
        if most > 1:
            held = identifiers.filter(col(self.keys[0]).isNotNull())
            touched = {r[0] for r in held.select(bucket_of(self.keys[0], most)).distinct().collect()}
        out = []
        for run in runs:
            rows = self._read(run)
            own = {b % run.buckets for b in touched}
            out.append(rows.filter(col(BUCKET).isin(sorted(own))) if run.buckets > 1 and len(own) < run.buckets else rows)
        return out

    def known(self, identifiers: DataFrame, before: int) -> DataFrame | None:
        """Indexed keys that may meet one of the identifiers; None while nothing is indexed."""
        scans = self.scans(identifiers, before)
        return reduce(DataFrame.unionByName, [s.select(*cols(self.keys)) for s in scans]) if scans else None
