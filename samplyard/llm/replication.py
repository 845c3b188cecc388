"""Mixing sources to target weights by Poisson replication.

Source s gets the rate r(s) = weight(s) / sum of weights * rows wanted / rows of s. A document is
repeated as often as a Poisson variable of that mean says; the variable is the inverse distribution
function at a number in [0, 1) that a hash of seed and doc_id gives, so it is the same in every run.
Copies are ordered globally by a hash of seed, doc_id and copy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of an md5 that make a number in [0, 1); 52 bits are exact in a double.
DIGITS = 13


def poisson_cdf(rate: float) -> tuple[int, np.ndarray]:
    """The least number with a term of weight, and the distribution function from it on.

    Terms are products from the mode, where they are largest, up and down, divided by their sum, so
    no mean is too large. Beyond the mean +- 12 deviations and 40 the function is 0 or 1 in a double.
    """
    mode = int(rate)
    reach = int(np.ceil(12 * np.sqrt(rate))) + 40
    low = max(0, mode - reach)
    down = np.cumprod(np.arange(mode, low, -1, dtype=np.float64) / rate) if rate else np.zeros(0)
    up = np.cumprod(rate / np.arange(mode + 1, mode + reach + 1, dtype=np.float64))
    total = np.cumsum(np.concatenate([down[::-1], [1.0], up]))
    return low, total / total[-1]


def hash_unit(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from the md5 of seed and parts."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double") / F.lit(float(16**DIGITS))


def rates(docs: DataFrame, weights: dict[str, float] | None = None, rows: int | None = None) -> DataFrame:
    """``source``, ``rate``, ``cdf`` and ``low`` of every source: the distribution function at
    ``low``, ``low + 1``, ...; it is 0 before.

    Without ``weights`` every source weighs the same; a source that ``weights`` doesn't name, null
    included, weighs nothing. ``rows``: rows wanted, as many as there are by default.
    """
    counted = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        counted = counted.withColumn("weight", F.lit(1.0))
    else:
        pairs = [x for k, w in sorted(weights.items()) for x in (F.lit(k), F.lit(float(w)))]
        known = F.create_map(*pairs)[F.col("source")] if pairs else F.lit(None).cast("double")
        counted = counted.withColumn("weight", F.coalesce(known, F.lit(0.0)))
    totals = counted.agg(F.sum("weight"), F.sum("n")).first()
    all_weights, wanted = F.lit(totals[0] or 1.0), F.lit(rows if rows is not None else totals[1] or 0)
    rated = counted.select(
        "source",
        F.when(F.col("weight") > 0, F.col("weight") / all_weights * wanted / F.col("n")).otherwise(F.lit(0.0)).alias("rate"),
    )

    def functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, rate in enumerate(batch.column("rate").to_pylist()):
                low, cdf = poisson_cdf(rate)
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [*row.columns, pa.array([low], pa.int32()), pa.array([cdf], pa.list_(pa.float64()))], ["source", "rate", "low", "cdf"]
                )

    kind = rated.schema["source"].dataType.simpleString()
    return rated.mapInArrow(functions, f"source {kind}, rate double, low int, cdf array<double>")


def replicate(docs: DataFrame, weights: dict[str, float] | None = None, rows: int | None = None, seed: int = 17) -> DataFrame:
    """Every column of ``docs``, with ``rate``, ``copies``, ``copy`` (from 0) and ``order_key``, one
    row for each copy, not yet ordered.

    Null sources are one source. Rows equal in doc_id are repeated equally often. An own column of
    one of these names is replaced.
    """
    docs = docs.drop("rate", "cdf", "copies", "copy", "order_key")
    table = rates(docs, weights, rows).withColumnsRenamed({"source": "rated_source", "low": "rated_low"})
    joined = docs.join(table, docs["source"].eqNullSafe(table["rated_source"])).drop("rated_source")
    draw = hash_unit(seed, F.col("doc_id"))
    # Copies: entries of the distribution function not above the draw, the zeros before ``low`` too; it is sorted.
    copies = F.aggregate("cdf", F.col("rated_low"), lambda n, p: n + (p <= F.col("draw")).cast("int"))
    counted = joined.withColumn("draw", draw).withColumn("copies", copies).drop("draw", "cdf", "rated_low").filter("copies > 0")
    return counted.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).withColumn(
        "order_key", hash_unit(seed + 1, F.col("doc_id"), F.col("copy"))
    )


def shuffle_globally(copies: DataFrame) -> DataFrame:
    """Rows in the order of ``order_key`` over all partitions; ties by doc_id and copy."""
    return copies.repartitionByRange("order_key", "doc_id", "copy").sortWithinPartitions("order_key", "doc_id", "copy")
