"""Centroid clustering of integer vectors with exact results: rounds of assignment and averaging.

Everything per vector is a column expression: ``zip_with`` and ``aggregate`` give the integer distance
to each centroid, a literal array, and ``array_min`` over (distance, number) chooses the cluster. A
round adds up every component in one aggregate that combines on the map side, so a cluster that holds
most vectors is no task's work. Only ``k`` rows of sums reach the driver, whatever the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplyard.llm.tables import staged

#: Components are held within +-REACH, so that squared distances of 64 of them fit a long.
REACH = 1 << 27
LARGEST = (1 << 63) - 1
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def integer_vectors(vectors: DataFrame, dims: int = 64, scale: int = 64) -> DataFrame:
    """``vec_id, vec``: floor(scale * component) of the vectors with ``dims`` finite components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(
        F.col("embedding").cast("array<double>"),
        lambda x: F.floor(F.greatest(F.least(x * float(scale), F.lit(float(REACH - 1))), F.lit(float(-REACH)))),
    )
    return vectors.filter(F.size("embedding") == dims).filter(finite).select("vec_id", scaled.alias("vec"))


def first_centroids(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest sha256 of ``seed:vec_id``; equal ones by their components,
    those without a vec_id last."""
    draw = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("vec_id").cast("string")), 256)
    ordered = kept.select(F.when(F.col("vec_id").isNotNull(), draw).alias("draw"), "vec")
    rows = ordered.orderBy(F.asc_nulls_last("draw"), "vec").limit(k).collect()
    return [list(r.vec) for r in rows]


def distance(vec: Column, centroid: Sequence[int]) -> Column:
    """Squared Euclidean distance to a literal centroid."""
    squares = F.zip_with(vec, F.lit(list(centroid)).cast("array<bigint>"), lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0).cast("bigint"), lambda total, x: total + x)


def nearest(vec: Column, centroids: Sequence[Sequence[int]]) -> Column:
    """Struct of distance and number of the nearest centroid; the smaller number wins ties."""
    options = [F.struct(distance(vec, c).alias("distance"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)]
    return F.array_min(F.array(*options))


def averaged(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The next centroids: floor of the mean of each component; an empty cluster keeps its own."""
    dims = len(centroids[0])
    chosen = kept.select(nearest(F.col("vec"), centroids)["cluster"].alias("cluster"), "vec")
    sums = chosen.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(F.col("vec")[i]).alias(f"s{i}") for i in range(dims)])
    moved = list(centroids)
    for row in sums.collect():
        moved[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(dims)]
    return moved


def fit(kept: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1) -> list[list[int]]:
    """Centroids after the given rounds; fewer than ``k`` when there are fewer vectors."""
    centroids = first_centroids(kept, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = averaged(kept, centroids)
    return centroids


def _total(values) -> int:
    return min(sum(values), LARGEST)


def cluster_vectors(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector.

    Kept are vectors with ``dims`` components, none null or non-finite; others give no row, whatever
    their vec_id. Rows that repeat a vec_id, or have none, each stand for a vector; without a vec_id
    one is the last to become a first centroid. Components beyond +-2**27 after scaling are held
    there, and sums of distances that a long can't hold are the largest long. An empty table, or one
    without kept vectors, gives no rows. Other columns are left out.
    """
    spark = vectors.sparkSession
    kept = staged(integer_vectors(vectors, dims, scale), "vectors")
    centroids = fit(kept, k, rounds, seed)
    if not centroids:
        return spark.createDataFrame([], RESULT)
    chosen = kept.select("vec_id", nearest(F.col("vec"), centroids).alias("nearest"))
    rows = staged(chosen.select("vec_id", "nearest.cluster", "nearest.distance"), "clustered")
    # try_sum is null where a long overflows; there are k rows at most, here and in the join below.
    sums = {r.cluster: r.total for r in rows.groupBy("cluster").agg(F.try_sum("distance").alias("total")).collect()}
    inertia = {c: LARGEST if total is None else total for c, total in sums.items()}
    text = [",".join(map(str, c)) for c in centroids]
    facts = spark.createDataFrame([(c, n, text[c]) for c, n in inertia.items()], "cluster int, cluster_inertia long, text string")
    return rows.join(F.broadcast(facts), "cluster").select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        F.lit(_total(inertia.values())).cast("long").alias("inertia"),
        F.sha2("text", 256).alias("centroid_sha256"),
    )


def oracle(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1) -> str:
    """SQL for the rows of :func:`cluster_vectors`, where nothing reaches the bounds."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS (
  SELECT n, vec_id, v, min(row(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, cluster)) AS best
  FROM kept, c{r} GROUP BY n, vec_id, v
)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (
  SELECT cluster, list(mean ORDER BY i) AS c FROM (
    SELECT best[2] AS cluster, i, (sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS mean
    FROM a{r}, range(1, {dims + 1}) AS t(i) GROUP BY 1, 2)
  GROUP BY cluster
),
c{r + 1} AS (SELECT cluster, coalesce(m{r}.c, c{r}.c)::BIGINT[] AS c FROM c{r} LEFT JOIN m{r} USING (cluster))""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: isfinite(x))) = {dims} AND len(embedding) = {dims}
),
c0 AS (
  SELECT (row_number() OVER (ORDER BY h NULLS LAST, v) - 1)::INTEGER AS cluster, v AS c
  FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM kept ORDER BY h NULLS LAST, v LIMIT {k})
),{",".join(steps)}
SELECT vec_id, best[2] AS cluster, best[1] AS distance, sum(best[1]) OVER (PARTITION BY best[2])::BIGINT AS cluster_inertia,
       sum(best[1]) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON cluster = best[2]"""
