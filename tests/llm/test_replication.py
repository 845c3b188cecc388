import hashlib
import math
from collections import Counter
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from samplyard.llm import queries
from samplyard.llm.replication import rates, replicate, shuffle_globally


def unit(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 16**13


def poisson(u, mean):
    if mean == 0:
        return 0
    term = total = math.exp(-mean)
    k = 0
    while total <= u and k < mean + 12 * math.sqrt(mean) + 40:
        k += 1
        term *= mean / k
        total += term
    return k


@pytest.mark.parametrize("weights,rows", [(None, None), ({"hot": 3.0, "s1": 1.0}, 500), ({}, None)])
def test_against_brute_force(documents, cases, weights, rows):
    n = Counter(r[3] for r in cases)
    weight = {s: 1.0 if weights is None else weights.get(s, 0.0) for s in n}
    total = sum(weight.values()) or 1.0
    mean = {s: weight[s] / total * (rows or len(cases)) / n[s] for s in n}
    want = Counter()
    for r in cases:
        key = "null" if r[0] is None else r[0]
        for copy in range(poisson(unit(f"17:{key}"), mean[r[3]])):
            want[(r[0], r[3], copy, round(unit(f"18:{key}:{copy}"), 12))] += 1
    got = replicate(documents, weights, rows).collect()
    assert Counter((r["doc_id"], r["source"], r["copy"], round(r["order_key"], 12)) for r in got) == want


def test_order_is_global_and_repeatable(documents):
    once = [tuple(r) for r in shuffle_globally(replicate(documents)).collect()]
    keys = [r[-1] for r in once]
    assert keys == sorted(keys)
    again = [tuple(r) for r in shuffle_globally(replicate(documents.repartition(3))).collect()]
    assert sorted(map(str, once)) == sorted(map(str, again))


def test_expected_counts(spark):
    df = spark.range(20000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"))
    got = {r["source"]: r["count"] for r in replicate(df, {"a": 2.0, "b": 1.0}).groupBy("source").count().collect()}
    assert abs(got["a"] - 13333) < 500 and abs(got["b"] - 6667) < 400


def test_empty_table_limit_and_clashing_columns(nothing, documents, spark):
    assert replicate(nothing).count() == 0
    assert rates(nothing).count() == 0
    clash = documents.withColumns({c: F.lit("x") for c in ("rate", "cdf", "copies", "copy", "order_key", "extra")})
    assert replicate(clash).count() == replicate(documents).count()
    one = replicate(spark.createDataFrame([(1, "a")], "doc_id long, source string"), rows=10_000)
    assert one.count() == exact_poisson(unit("17:1"), 10_000)


def exact_poisson(u, mean):
    """The inverse distribution function in decimals, which hold exp(-mean) of any mean."""
    with localcontext() as context:
        context.prec = 60
        term = total = (-Decimal(mean)).exp()
        k = 0
        while total <= Decimal(u):
            k += 1
            term *= Decimal(mean) / k
            total += term
        return k


@pytest.mark.parametrize("mean", [0.4, 690, 700.5, 3000, 20000])
def test_means_of_any_size(spark, mean):
    df = spark.range(20).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"))
    got = {r["doc_id"]: r["count"] for r in replicate(df, rows=mean * 20).groupBy("doc_id").count().collect()}
    assert {i: got.get(i, 0) for i in range(20)} == {i: exact_poisson(unit(f"17:{i}"), mean) for i in range(20)}


def test_one_row_of_a_source_among_many(spark):
    """Equal weights: the only row without a source has a twentieth of all rows as its mean."""
    df = spark.range(30001).select(F.col("id").alias("doc_id"), F.when(F.col("id") > 0, F.concat(F.lit("s"), F.col("id") % 20)).alias("source"))
    got = {r["source"]: r["count"] for r in replicate(df).groupBy("source").count().collect()}
    assert got[None] == exact_poisson(unit("17:0"), 30001 / 21)
    assert len(got) == 21 and all(abs(n - 30001 / 21) < 200 for n in got.values())


def test_query_mixes_whole_documents(spark, documents, tmp_path, monkeypatch):
    """What is dealt out and ordered are the documents with their texts, not their ids."""
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    written = {}
    monkeypatch.setattr(queries, "staged", lambda df, label, put=queries.staged: written.setdefault(label, put(df, label)))
    index = [tuple(r) for r in queries.op9_poisson_mixing(spark, str(tmp_path)).collect()]
    assert [r[-1] for r in index] == sorted(r[-1] for r in index)
    mixed = [r.asDict() for r in written["mixed"].collect()]
    columns = ("doc_id", "source", "rate", "copies", "copy", "order_key")
    assert Counter(tuple(r[c] for c in columns) for r in mixed) == Counter(index)
    whole = [tuple(r) for r in documents.collect()]
    want = Counter()
    for r in replicate(documents).collect():
        want[tuple(r[c] for c in documents.columns)] += 1
    assert Counter(tuple(r[c] for c in documents.columns) for r in mixed) == want and set(want) <= set(whole)
