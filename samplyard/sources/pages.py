"""Whether the landed pages of a listing are all there.

A result page says where it starts and how many items the listing has. Pages that were fetched twice, overlap
their neighbours or are missing show in the spans they cover: gaps and islands over the offsets of a
listing. Only the spans, no items, are compared.

A listing of any length is compared in slices of ``SLICE`` positions: how far the pages of earlier slices
reach comes from one row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplyard.functions.columns import col, cols
from samplyard.operators.joins import first_per_key
from samplyard.sources.datasets import page_of

SLICE = 1_000_000
PAGE, START, STOP = "page", "start", "stop"


def _parsed(pages: DataFrame, item: str, column: str) -> Column:
    return F.from_json(col(column), page_of(item))


def page_spans(pages: DataFrame, listing: Sequence[str], item: str, column: str = "value") -> DataFrame:
    """One row per distinct page: listing, ``start``, ``stop``, ``total``, ``copies``, ``miscounted``.

    The items that are there decide where a page stops; ``miscounted`` marks pages that claim another number.
    Pages without a readable offset have no span. Pages of equal text are copies of one.
    """
    parsed = pages.select(*cols(listing), F.sha2(col(column), 256).alias("digest"), _parsed(pages, item, column).alias(PAGE))
    paging, found = col(PAGE)["Paging"], F.coalesce(F.size(col(PAGE)["Items"]), F.lit(0))
    spans = parsed.select(
        *cols(listing),
        "digest",
        paging["Offset"].alias(START),
        (paging["Offset"] + found).alias(STOP),
        paging["TotalCount"].alias("total"),
        (~paging["DisplayedCount"].eqNullSafe(found.cast("bigint"))).alias("miscounted"),
    )
    facts = [START, STOP, "total", "miscounted"]
    return spans.groupBy(*cols(listing), "digest", *facts).agg(F.count(F.lit(1)).alias("copies")).drop("digest")


def reached_spans(spans: DataFrame, listing: Sequence[str], slice_size: int = SLICE) -> DataFrame:
    """Spans with ``reached``: where the pages that start before end at the furthest."""
    placed = spans.filter(col(START).isNotNull()).withColumn("__slice", F.floor(col(START) / slice_size))
    keys = cols(listing)
    ends = placed.groupBy(*keys, "__slice").agg(F.max(STOP).alias("__end"))
    earlier = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "__slice", F.max("__end").over(earlier).alias("__carried"))
    inside = Window.partitionBy(*keys, "__slice").orderBy(START, STOP, "total").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("__local", F.max(STOP).over(inside))
    # A listing without a name meets itself.
    same = [local[n].eqNullSafe(carried[n]) for n in [*listing, "__slice"]]
    joined = local.join(carried, same)
    reached = F.greatest(local["__local"], carried["__carried"], F.lit(0).cast("bigint"))
    return joined.select(*[local[n] for n in spans.columns], F.coalesce(reached, F.lit(0)).alias("reached"))


def missing_ranges(spans: DataFrame, listing: Sequence[str], slice_size: int = SLICE) -> DataFrame:
    """Positions that no page covers, as ranges: listing, ``start``, ``stop`` (exclusive)."""
    reached = reached_spans(spans, listing, slice_size)
    before = reached.filter(col(START) > col("reached")).select(*cols(listing), col("reached").alias(START), col(START).alias(STOP))
    ends = spans.groupBy(*cols(listing)).agg(F.coalesce(F.max(STOP), F.lit(0)).alias(START), F.max("total").alias(STOP))
    return before.unionByName(ends.filter(col(START) < col(STOP)))


def completeness(spans: DataFrame, listing: Sequence[str], slice_size: int = SLICE) -> DataFrame:
    """One row per listing: pages, positions and a status.

    ``repeated`` counts pages fetched again, ``overlapping`` positions that several different pages
    cover, ``gaps`` and ``missing`` ranges and positions that none does. The status is the first that
    holds: ``unreadable``, ``miscounted``, ``total_changed``, ``incomplete``, ``overlapping``, ``complete``.
    """
    reached = reached_spans(spans, listing, slice_size)
    over = F.greatest(F.least("reached", STOP) - col(START), F.lit(0))
    before = F.greatest(col(START) - col("reached"), F.lit(0))
    keys = cols(listing)
    inner = reached.groupBy(*keys).agg(
        F.sum(over).alias("overlapping"), F.sum(before).alias("__inner"), F.count_if(before > 0).alias("__inner_gaps")
    )
    outer = spans.groupBy(*keys).agg(
        F.sum("copies").alias("pages"),
        F.sum(col("copies") - 1).alias("repeated"),
        F.max("total").alias("total"),
        F.coalesce(F.max(STOP), F.lit(0)).alias("__end"),
        F.bool_or("miscounted").alias("__miscounted"),
        F.bool_or(col(START).isNull()).alias("__unreadable"),
        (F.min("total") < F.max("total")).alias("__changed"),
    )
    tail = F.greatest(F.coalesce("total", F.lit(0)) - col("__end"), F.lit(0))
    joined = outer.join(inner, [outer[n].eqNullSafe(inner[n]) for n in listing], "left")
    facts = joined.select(
        *[outer[n] for n in listing],
        "pages", "repeated", "total",
        F.coalesce("overlapping", F.lit(0)).alias("overlapping"),
        (F.coalesce("__inner_gaps", F.lit(0)) + F.when(tail > 0, 1).otherwise(0)).cast("bigint").alias("gaps"),
        (F.coalesce("__inner", F.lit(0)) + tail).alias("missing"),
        "__unreadable", "__miscounted", "__changed",
    )
    status = (
        F.when(col("__unreadable"), "unreadable")
        .when(col("__miscounted"), "miscounted")
        .when(col("__changed"), "total_changed")
        .when(col("missing") > 0, "incomplete")
        .when(col("overlapping") > 0, "overlapping")
        .otherwise("complete")
    )
    return facts.select(*keys, "pages", "repeated", "total", "overlapping", "gaps", "missing", status.alias("status"))


def positioned_items(pages: DataFrame, listing: Sequence[str], item: str, column: str = "value") -> DataFrame:
    """Every item once: listing, ``position``, ``item``; of several at a position, that of the earliest page."""
    parsed = pages.select(*cols(listing), _parsed(pages, item, column).alias(PAGE))
    start = col(PAGE)["Paging"]["Offset"]
    rows = parsed.filter(start.isNotNull()).select(*cols(listing), start.alias(START), F.posexplode(col(PAGE)["Items"]).alias("at", "item"))
    placed = rows.select(*cols(listing), (col(START) + col("at")).alias("position"), START, "item")
    return first_per_key(placed, [*listing, "position"], [col(START), F.to_json("item")]).drop(START)
