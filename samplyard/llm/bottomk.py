"""Bottom-k sketches of 5-word shingles: mergeable fingerprints of documents.

A sketch is the ``k`` smallest distinct 64-bit shingle hashes, ascending. With fewer than ``k`` it is
the whole set and every estimate is exact. The sketch of a union is the ``k`` smallest of both.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from samplyard.llm.tables import partitions, pieces, texts_of
from samplyard.llm.words import run_hashes, shingles, word_hashes

WORDS = 5
SIZE = 128
FIRST = -(1 << 63)  # where rows without a doc_id stand
FINGERPRINTS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, in_edited double, distinct_shingles double"
)


def sketches(texts: list[bytes], k: int = SIZE, words: int = WORDS) -> list[np.ndarray]:
    """The sketch of every text."""
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    _, _, hashes, at = word_hashes(data, bounds)
    runs = run_hashes(hashes, words)
    return [shingles(hashes[a:b], words, runs[a : b - words + 1])[:k] for a, b in zip(at[:-1], at[1:])]


def merge(a: np.ndarray, b: np.ndarray, k: int = SIZE) -> np.ndarray:
    """Sketch of the union of two sets."""
    return np.unique(np.concatenate([a, b]))[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = SIZE) -> float:
    """Estimated |A and B| / |A or B|; 1 for two empty sets."""
    both = np.sort(np.concatenate([a, b]))
    if not len(both):
        return 1.0
    twice = both[1:] == both[:-1]
    distinct = both[np.concatenate([[True], ~twice])]
    if len(a) >= k or len(b) >= k:
        distinct = distinct[:k]
    return float(np.count_nonzero(both[1:][twice] <= distinct[-1]) / len(distinct))


def distinct_count(a: np.ndarray, k: int = SIZE) -> float:
    """Estimated number of shingles in the set."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[k - 1]) + 1.0) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, k: int = SIZE) -> float:
    """Estimated |A and B| / |A|; 1 for an empty A."""
    if not len(a):
        return 1.0
    union = distinct_count(merge(a, b, k), k) if len(a) >= k or len(b) >= k else len(np.union1d(a, b))
    return min(1.0, resemblance(a, b, k) * union / distinct_count(a, k))


def encode(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").tobytes()).decode()


def decode(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def group_sketches(docs: DataFrame, by: str, k: int = SIZE) -> DataFrame:
    """``by``, ``fingerprint`` of all documents of a group together.

    Each task merges what it reads into one sketch for a group and batch; the rest are merged in
    two rounds, so that a hot group isn't one task's work.
    """
    kind = docs.schema[by].dataType.simpleString()

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found: dict = {}
            keys = batch.column(by).to_pylist()
            for key, sketch in zip(keys, sketches([t.encode() for t in batch.column("text").to_pylist()], k)):
                found[key] = merge(found[key], sketch, k) if key in found else sketch
            yield pa.RecordBatch.from_pydict(
                {by: pa.array(list(found), batch.schema.field(by).type), "fingerprint": [encode(s) for s in found.values()]}
            )

    def merged(pdf):
        total = np.zeros(0, np.uint64)
        for text in pdf["fingerprint"]:
            total = merge(total, decode(text), k)
        return pdf.iloc[:1].assign(fingerprint=encode(total))

    parts = docs.select(by, F.coalesce("text", F.lit("")).alias("text")).mapInArrow(part, f"`{by}` {kind}, fingerprint string")
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("fingerprint"), F.lit(partitions(docs.sparkSession))))
    once = salted.groupBy(by, "salt").applyInPandas(merged, salted.schema).drop("salt")
    return once.groupBy(by).applyInPandas(merged, once.schema)


def with_successor_blocks(docs: DataFrame) -> DataFrame:
    """``block, tail, doc_id, text``: rows cut into blocks by doc_id, and at the end of each block
    (``tail`` 1) a copy of the row that follows its last one, after the last block the first row.

    Order: doc_id (null first), then text. Blocks come from approximate quantiles of doc_id; only
    their sizes depend on these.
    """
    spark = docs.sparkSession
    count = 4 * partitions(spark)
    order = F.coalesce(F.col("doc_id"), F.lit(FIRST))
    shares = [i / count for i in range(1, count)]
    cuts = docs.agg(F.percentile_approx(order, shares, 20 * count)).first()[0] or []
    edges = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def block_of(ids):
        return pd.Series(np.searchsorted(edges, ids.to_numpy(), "right").astype("int32"))

    rows = docs.select("doc_id", order.alias("place"), "text").withColumn("block", block_of("place"))
    least = rows.groupBy("block").agg(F.min("place").alias("place"))
    # One row for a block, ``4 * partitions`` at most: a proven bound.
    firsts = rows.join(F.broadcast(least), ["block", "place"]).groupBy("block").agg(F.min(F.struct("place", "text", "doc_id")).alias("first"))
    listed = Window.orderBy("block")
    before = F.coalesce(F.lag("block").over(listed), F.max("block").over(listed.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    tails = firsts.select(before.alias("block"), F.lit(1).alias("tail"), "first.place", "first.doc_id", "first.text")
    return rows.select("block", F.lit(0).alias("tail"), "place", "doc_id", "text").unionByName(tails)


def fingerprints(docs: DataFrame, k: int = SIZE, words: int = WORDS) -> DataFrame:
    """For every row its sketch, the sketch of its edited text (the last half of the characters
    replaced by as many first ones of the next row, or all it has) and their likeness.

    A null text counts as empty. Next: in the order of doc_id, null first, then text; after the last
    row the first. A table of one row is its own successor; an empty one gives no rows. Equal texts
    have equal fingerprints; that of an empty text is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for batch in pieces(batches):
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("block", "doc_id", "text"))))
            if carried is not None:
                rows.insert(0, carried)
            carried = rows[-1]
            pairs = [i for i in range(len(rows) - 1) if rows[i][0] == rows[i + 1][0]]
            edited = []
            for i in pairs:
                text, following = rows[i][2], rows[i + 1][2]
                half = len(text) // 2
                edited.append((text[: len(text) - half] + following[:half]).encode())
            found = sketches([r[2].encode() for r in rows] + edited, k, words)
            own, changed = found[: len(rows)], found[len(rows) :]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[i][1] for i in pairs], pa.int64()),
                    pa.array([len(rows[i][2]) for i in pairs], pa.int64()),
                    pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
                    pa.array([encode(own[i]) for i in pairs], pa.string()),
                    pa.array([encode(c) for c in changed], pa.string()),
                    pa.array([resemblance(own[i], c, k) for i, c in zip(pairs, changed)], pa.float64()),
                    pa.array([resemblance(own[i], own[i + 1], k) for i in pairs], pa.float64()),
                    pa.array([containment(own[i], c, k) for i, c in zip(pairs, changed)], pa.float64()),
                    pa.array([distinct_count(own[i], k) for i in pairs], pa.float64()),
                ],
                [f.split()[0] for f in FINGERPRINTS.split(", ")],
            )

    rows = with_successor_blocks(texts_of(docs)).repartition("block").sortWithinPartitions("block", "tail", "place", "text")
    return rows.select("block", "doc_id", "text").mapInArrow(run, FINGERPRINTS)
