"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Words hash into ``SLOTS`` slots. Every slot has a fixed sparse index vector of -1, 0 and 1; the
context vector of a slot is the sum of the index vectors of its neighbours within two words, over all
documents, labelled or not. Sums are whole numbers, so they are the same in every run. A
document is the mean of its words' vectors with a few shape features; a network with one hidden layer
learns on the sample, and a temperature fitted on a part it didn't learn from calibrates its scores.
The model has a fixed size; only the sample, bounded by ``sample``, is gathered by the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplyard.llm.tables import BATCH, BATCH_BYTES, pieces, settings, staged, text_buffer, texts_of
from samplyard.llm.words import mix, seeded, word_hashes

SLOT_BITS = 14
SLOTS = 1 << SLOT_BITS
SIZE = 64
REACH = 2
#: Features beside the pooled vector.
SHAPES = 4
#: Slots whose sums travel in one row.
BLOCK = 1024
#: Labelled rows the model is fitted on, at most.
SAMPLE = 12_000
THRESHOLD = 0.3
FOLDS = 5


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(FOLDS))


def index_vectors() -> np.ndarray:
    """One entry in eight is 1 or -1."""
    draw = seeded(SLOTS * SIZE, 5) >> np.uint64(60)
    return np.where(draw == 0, 1, np.where(draw == 1, -1, 0)).astype(np.int16).reshape(SLOTS, SIZE)


def word_slots(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slot and hash of every word, and where the words of each text start."""
    _, _, hashes, at = word_hashes(*text_buffer(batch.column("text")))
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64), hashes, at


def context_sums(docs: DataFrame) -> np.ndarray:
    """The context vector of every slot over these documents."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total = index_vectors(), np.zeros((SLOTS, SIZE), np.int64)
        # A text byte takes about 100 bytes of vectors.
        for batch in pieces(batches, 1 << 17):
            slots, _, at = word_slots(batch)
            if not len(slots):
                continue
            doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
            vectors = index[slots]
            near = np.zeros_like(vectors)
            for j in range(1, REACH + 1):
                same = (doc[j:] == doc[:-j])[:, None]
                near[j:] += vectors[:-j] * same
                near[:-j] += vectors[j:] * same
            order = np.argsort(slots, kind="stable")
            first = np.flatnonzero(np.diff(slots[order], prepend=-1))
            total[slots[order][first]] += np.add.reduceat(near[order].astype(np.int32), first, axis=0)
        for i in range(0, SLOTS, BLOCK):
            if total[i : i + BLOCK].any():
                yield pa.RecordBatch.from_pydict({"block": np.array([i]), "sums": [total[i : i + BLOCK].astype("<i8").tobytes()]})

    def merged(pdf):
        sums = sum(np.frombuffer(b, "<i8") for b in pdf["sums"])
        return pdf.iloc[:1].assign(sums=[sums.astype("<i8").tobytes()])

    parts = docs.select("text").mapInArrow(add, "block long, sums binary")
    # SLOTS * SIZE numbers: a proven bound.
    with settings(docs.sparkSession, {BATCH: f"{BATCH_BYTES}b"}):
        rows = parts.groupBy("block").applyInPandas(merged, parts.schema).toArrow()
    total = np.zeros((SLOTS, SIZE), np.float32)
    for block, sums in zip(rows.column("block").to_pylist(), rows.column("sums").to_pylist()):
        total[block : block + BLOCK] = np.frombuffer(sums, "<i8").reshape(BLOCK, SIZE)
    return total


def word_vectors(context: np.ndarray) -> np.ndarray:
    """Unit context vector plus half the unit index vector; the latter alone for an unseen slot."""

    def unit(x):
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    return (unit(context) + 0.5 * unit(index_vectors().astype(np.float32))).astype(np.float32)


def features(batch: pa.RecordBatch, vectors: np.ndarray) -> np.ndarray:
    """Pooled vector, its length, log of the word count, share of distinct words and share of words
    equal to the one before, of every text."""
    slots, hashes, at = word_slots(batch)
    counts = np.diff(at)
    pooled = np.zeros((len(counts), SIZE + SHAPES), np.float32)
    full = np.flatnonzero(counts)
    if len(full):
        pooled[full, :SIZE] = np.add.reduceat(vectors[slots], at[full], axis=0) / counts[full, None]
        doc = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
        keys = np.sort((mix(hashes) >> np.uint64(24)) | (doc << np.uint64(40)))
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        distinct = np.bincount((keys[new] >> np.uint64(40)).astype(np.int64), minlength=len(counts))
        pooled[full, SIZE] = np.log1p(counts[full])
        pooled[full, SIZE + 1] = distinct[full] / counts[full]
        again = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])])
        pooled[full, SIZE + 2] = np.add.reduceat(again.astype(np.int64), at[full]) / counts[full]
        pooled[full, SIZE + 3] = np.sqrt(np.square(pooled[full, :SIZE]).sum(axis=1))
    return pooled


@dataclass
class Network:
    """Two layers over standardised features; ``temperature`` divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(((x - self.mean) / self.scale) @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, rounds: int = 1500, decay: float = 5e-3) -> Network:
    """Adam on the log loss in small batches, in a fixed order. Without rows, or with rows of one
    class, the scores are the smoothed share of label 1."""
    width = x.shape[1] if x.ndim == 2 else SIZE + SHAPES
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    prior = float(np.log(share / (1 - share)))
    if len(y) < 2 or y.min() == y.max():
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), prior)
    rng = np.random.default_rng(11)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - mean) / scale
    weights = [rng.normal(0, width**-0.5, (width, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.array(prior)]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    for step in range(1, rounds + 1):
        rows = rng.integers(0, len(y), 256)
        h = np.tanh(z[rows] @ weights[0] + weights[1])
        error = 1 / (1 + np.exp(-(h @ weights[2] + weights[3]))) - y[rows]
        back = error[:, None] * weights[2] * (1 - h * h) / len(rows)
        slopes = [z[rows].T @ back + decay * weights[0], back.sum(0), h.T @ error / len(rows) + decay * weights[2], error.mean()]
        rate = 0.01 * (1 - step / (rounds + 1))
        for i, slope in enumerate(slopes):
            m, v = moments[i]
            m += 0.1 * (slope - m)
            v += 0.001 * (slope * slope - v)
            weights[i] = weights[i] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(mean, scale, weights[0], weights[1], weights[2], float(weights[3]))


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, from a grid."""
    if not len(y) or y.min() == y.max():
        return 1.0
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 101))
    losses = [np.mean(np.logaddexp(0, np.where(y == 1, -logits, logits) / t)) for t in grid]
    return float(grid[int(np.argmin(losses))])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    """Word vectors from all rows; network and temperature from at most ``sample`` labelled rows
    outside the held-out fold."""
    usable = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(fold(F.col("doc_id")) != 0)
    chosen = usable.groupBy("doc_id").agg(F.min("quality").alias("label"))
    # ``sample`` rows at most: a proven bound.
    chosen = staged(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "labels")
    rows = texts_of(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    rows = staged(rows.repartition(F.xxhash64("doc_id")), "sample")
    vectors = word_vectors(context_sums(texts_of(docs)))

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = features(batch, vectors)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "label": batch.column("label"), "x": [r.astype("<f4").tobytes() for r in rows]}
            )

    with settings(docs.sparkSession, {BATCH: f"{BATCH_BYTES}b"}):
        table = rows.withColumn("label", F.col("label").cast("long")).mapInArrow(pool, "doc_id long, label long, x binary").toArrow()
    ids = np.array(table.column("doc_id").to_pylist(), np.int64)
    y = np.array(table.column("label").to_pylist(), np.float64)
    x = np.array([np.frombuffer(b, "<f4") for b in table.column("x").to_pylist()], np.float64).reshape(len(y), SIZE + SHAPES)
    # The same rows in the same order in every run, whatever the tasks' order was.
    order = np.lexsort([x[:, 0], ids]) if len(ids) else np.zeros(0, np.int64)
    ids, x, y = ids[order], x[order], y[order]
    aside = mix(ids.astype(np.uint64)) % np.uint64(5) == 0
    network = fit_network(x[~aside], y[~aside])
    network.temperature = fit_temperature(network.logits(x[aside]), y[aside]) if aside.any() else 1.0
    return vectors, network


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``score`` (0 to 1) of every row after its own columns, from the text alone.

    A null text counts as empty; empty texts have a score too. Labels that are null, held out or of
    no document are left out; without labels every score is one half. An own ``score`` column is replaced.
    """
    vectors, network = fit(docs, labels, sample)
    docs = docs.drop("score")
    columns = docs.columns
    model = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, network = model.value
        for batch in pieces(batches):
            # Rounded, since the last digits of a matrix product depend on how many rows it has.
            values = np.round(network.scores(features(batch, vectors).astype(np.float64)), 6)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], [*columns, "score"])

    filled = docs.withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return filled.mapInArrow(score, schema + ", score double")


def predicted(score: Column, threshold: float = THRESHOLD) -> Column:
    return (score >= threshold).cast("int")
