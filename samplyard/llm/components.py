"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplyard.llm.tables import release, staged
from samplyard.session import work_path


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (the least id reachable) of every id in ``links`` (``a, b``).

    Large and small stars in turn until no edge changes; each round has joins and aggregates by id
    only and is written to the shared folder, in place of the round before it. No component is ever
    one task's work.
    """
    spark, folder, turn = links.sparkSession, work_path(links.sparkSession, "components"), 0
    edges = staged(links.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "0", folder)
    before = None
    while True:
        # Large star: every larger neighbour of an id goes to the least id around it.
        both = edges.select(F.col("v").alias("c"), F.col("u").alias("n")).unionByName(edges.select(F.col("u").alias("c"), F.col("v").alias("n")))
        least = both.groupBy("c").agg(F.min("n").alias("n")).select("c", F.least("c", "n").alias("m"))
        large = both.filter("n > c").join(least, "c").select(F.col("n").alias("v"), F.col("m").alias("u")).distinct()
        # Small star: every smaller neighbour of an id, and the id, go to the least of them.
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(least, "v")
        small = joined.select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(least.select("v", F.col("m").alias("u")))
        edges = staged(small.filter("v <> u").distinct(), f"{turn + 1}", folder)
        release(spark, folder, f"{turn}")
        turn += 1
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.groupBy(F.col("v").alias("id")).agg(F.min("u").alias("component")).unionByName(
        edges.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct()
    ).groupBy("id").agg(F.min("component").alias("component"))
