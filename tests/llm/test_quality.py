import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from samplyard.llm import quality as Q

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    scored = Q.score_documents(docs.select("doc_id", "text"), labels)
    rows = scored.join(labels, "doc_id").filter(Q.fold(F.col("doc_id")) == 0).collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    right = np.mean([(r["score"] >= Q.THRESHOLD) == (r["quality"] == 1) for r in rows])
    assert auc > 0.9 and right > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_same_result_in_every_run_and_without_the_held_out_labels(spark, documents):
    rng = random.Random(4)
    labels = [(i * 3, rng.randrange(2), 0) for i in range(100)]
    schema = "doc_id long, quality int, toxic int"
    flipped = [(d, 1 - q if zlib.crc32(str(d).encode()) % 5 == 0 else q, t) for d, q, t in labels]
    runs = [
        sorted(map(str, Q.score_documents(documents.repartition(n), spark.createDataFrame(rows, schema)).collect()))
        for n, rows in ((2, labels), (7, labels), (3, flipped))
    ]
    assert runs[0] == runs[1] == runs[2]


def test_other_columns_do_not_matter(spark, documents):
    labels = spark.createDataFrame([(i * 3, i % 2, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    plain = Q.score_documents(documents.select("doc_id", "text"), labels)
    changed = documents.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy")).withColumn("score", F.lit("zz"))
    more = Q.score_documents(changed, labels).select("doc_id", "text", "score")
    assert sorted(map(str, plain.collect())) == sorted(map(str, more.collect()))


def test_no_labels_one_class_and_nulls(spark, documents, nothing):
    schema = "doc_id long, quality int, toxic int"
    none = Q.score_documents(documents, spark.createDataFrame([], schema)).collect()
    assert {round(r["score"], 6) for r in none} == {0.5} and len(none) == documents.count()
    one = Q.score_documents(documents, spark.createDataFrame([(3, 1, 0), (6, 1, 0), (9, None, 0), (None, 1, 1)], schema)).collect()
    assert all(r["score"] > 0.5 for r in one)
    assert Q.score_documents(nothing, spark.createDataFrame([(3, 1, 0)], schema)).count() == 0


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 2000).astype(float)
    logits = np.where(y == 1, 1, -1) * 6.0 * np.where(rng.random(2000) < 0.8, 1, -1)
    assert 3.5 < Q.fit_temperature(logits, y) < 5.5


def test_words_outside_the_sample_have_context(spark, documents, cases):
    """Word vectors come from the whole table, however few rows the network is fitted on."""
    labels = spark.createDataFrame([(i * 3, i % 2, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    few, many = (Q.fit(documents, labels, sample)[0] for sample in (5, 50))
    assert (few == many).all()
    index, sums = Q.index_vectors().astype(np.int64), np.zeros((Q.SLOTS, Q.SIZE), np.int64)
    for r in cases:
        batch = pa.RecordBatch.from_pydict({"text": [r[1] or ""]})
        slots = Q.word_slots(batch)[0]
        for i, slot in enumerate(slots):
            for j in range(max(0, i - Q.REACH), min(len(slots), i + Q.REACH + 1)):
                if j != i:
                    sums[slot] += index[slots[j]]
    assert (few == Q.word_vectors(sums.astype(np.float32))).all()
