"""Quality rules by N-gram perplexity, with lower and upper bands for each language.

Units are the bytes of the whole text after ``ORDER - 1`` zero bytes, so the number of distinct
N-grams grows slowly with the corpus. A gram is one integer: 23 bits of a hash of the language above
``ORDER`` bytes. Spark counts all grams of all documents and turns the counts into an interpolated
modified Kneser-Ney model (continuation counts, three discounts for each order), level by level, with
joins and windows whose groups have 256 rows at most. The model of the highest order is stored in
sorted hash arrays of a fixed number of entries each; documents are scored against one array after
the other, so what a task holds doesn't grow with the model. Log probabilities are whole numbers,
so sums don't depend on their order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplyard.llm.tables import pieces, staged, text_buffer
from samplyard.llm.words import mix, run_hashes, word_hashes

ORDER = 5
LANG_BITS = 23
#: Units of a natural logarithm in the stored whole numbers.
SCALE = 1 << 16
#: Entries of one sorted hash array (12 bytes each).
ARRAY_ENTRIES = 1 << 22
#: Grams a counting task holds before it adds equal ones up.
HELD = 1 << 21

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def language_code(lang: Column) -> Column:
    return F.xxhash64(F.coalesce(lang, F.lit("\0"))).bitwiseAND(F.lit((1 << LANG_BITS) - 1))


def grams(data: np.ndarray, bounds: np.ndarray, langs: np.ndarray) -> np.ndarray:
    """The gram that ends at each byte."""
    lengths = np.diff(bounds)
    padded = np.zeros(len(data) + (ORDER - 1) * len(lengths), np.uint8)
    places = np.arange(len(data)) + np.repeat((np.arange(len(lengths)) + 1) * (ORDER - 1), lengths)
    padded[places] = data
    keys = np.repeat(langs.astype(np.uint64) << np.uint64(8 * ORDER), lengths)
    for j in range(ORDER):
        keys |= padded[places - j].astype(np.uint64) << np.uint64(8 * j)
    return keys


def count_grams(docs: DataFrame) -> DataFrame:
    """``gram, n`` over all documents; ``docs`` has ``code`` and ``text`` without nulls."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def added(parts):
            keys = np.concatenate([k for k, _ in parts])
            counts = np.concatenate([c for _, c in parts])
            order = np.argsort(keys)
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            return keys[first], np.add.reduceat(counts, first)

        def out(keys, counts):
            for i in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[i : i + 100_000].astype(np.int64)), pa.array(counts[i : i + 100_000])], ["gram", "n"]
                )

        for batch in pieces(batches):
            data, bounds = text_buffer(batch.column("text"))
            if not len(data):
                continue
            keys, counts = np.unique(grams(data, bounds, batch.column("code").to_numpy()), return_counts=True)
            held.append((keys, counts))
            size += len(keys)
            if size > HELD:
                held = [added(held)]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield from out(*held[0])
                    held, size = [], 0
        if held:
            yield from out(*added(held))

    return docs.select("code", "text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _low(gram: Column, size: int) -> Column:
    """The gram with only its last ``size`` bytes."""
    high = F.shiftleft(F.shiftright(gram, 8 * ORDER), 8 * ORDER)
    return high.bitwiseOR(gram.bitwiseAND(F.lit((1 << (8 * size)) - 1)))


def _context(gram: Column) -> Column:
    """The gram without its last byte."""
    high = F.shiftleft(F.shiftright(gram, 8 * ORDER), 8 * ORDER)
    return high.bitwiseOR(F.shiftright(gram.bitwiseAND(F.lit((1 << (8 * ORDER)) - 1)), 8))


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of grams seen 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = counts
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    found = []
    for r, (now, more) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = r - (r + 1) * y * more / now if now else y
        found.append(min(max(d, 0.05), r - 0.05))
    return tuple(found)


def kneser_ney(counted: DataFrame) -> DataFrame:
    """``gram, q``: the natural logarithm of each counted gram's probability, times SCALE."""
    levels = {ORDER: counted}
    for size in range(ORDER - 1, 0, -1):
        # Continuation counts: in how many different ways a gram is preceded.
        levels[size] = staged(
            levels[size + 1].groupBy(_low(F.col("gram"), size).alias("gram")).agg(F.count("*").alias("n")), f"level{size}"
        )
    seen = None
    for size, level in levels.items():
        row = level.agg(*[F.coalesce(F.sum((F.col("n") == r).cast("long")), F.lit(0)).alias(f"n{r}") for r in range(1, 5)])
        row = row.withColumn("size", F.lit(size))
        seen = row if seen is None else seen.unionByName(row)
    # One row for each order.
    found = {r["size"]: discounts([r["n1"], r["n2"], r["n3"], r["n4"]]) for r in seen.collect()}
    lower = None
    for size in range(1, ORDER + 1):
        d1, d2, d3 = found[size]
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        siblings = Window.partitionBy(_context(F.col("gram")))
        level = levels[size].select(
            "gram",
            ((F.col("n") - discount) / F.sum("n").over(siblings)).alias("own"),
            (F.sum(discount).over(siblings) / F.sum("n").over(siblings)).alias("rest"),
        )
        if lower is None:
            level = level.withColumn("below", F.lit(1 / 256))
        else:
            level = level.withColumn("suffix", _low(F.col("gram"), size - 1)).join(lower, "suffix")
        lower = level.select(F.col("gram").alias("suffix"), (F.col("own") + F.col("rest") * F.col("below")).alias("below"))
    return lower.select(F.col("suffix").alias("gram"), F.round(F.log("below") * SCALE).cast("int").alias("q"))


class HashArray:
    """Values under 64-bit keys: hashes in ascending order, found from a table of their high bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = mix(keys)
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order]
        self.bits = max(1, min(24, int(len(keys)).bit_length() + 1))
        edges = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.starts = np.searchsorted(self.hashes, edges).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, 0 for those that aren't here."""
        values = np.zeros(len(keys), np.int64)
        if not len(self.hashes):
            return values
        hashes = mix(keys)
        places = self.starts[(hashes >> np.uint64(64 - self.bits)).astype(np.int64)]
        todo = np.arange(len(keys))
        while len(todo):
            inside = places < len(self.hashes)
            todo, places = todo[inside], places[inside]
            there = self.hashes[places]
            want = hashes[todo]
            hit = there == want
            values[todo[hit]] = self.values[places[hit]]
            onward = there < want
            todo, places = todo[onward], places[onward] + 1
        return values


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def text_counts(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """Words, their code points, symbols, repeated lines and words in repeated 3-word windows."""
    data, bounds = text_buffer(batch.column("text"))
    starts, ends, hashes, at = word_hashes(data, bounds)
    inside = np.zeros(len(data) + 1, np.int32)
    inside[starts] += 1
    inside[ends] -= 1
    in_word = np.cumsum(inside[:-1]).astype(bool)
    runs = run_hashes(hashes, 3)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(at))
    whole = doc[: len(runs)] == doc[2:] if len(runs) else np.zeros(0, bool)
    places = np.flatnonzero(whole)
    keys = mix(runs[places] + doc[places].astype(np.uint64))
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes), bool)
    for j in range(3):
        covered[places[twice] + j] = True
    raw = data.tobytes()
    repeated = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        lines = [line for line in raw[a:b].split(b"\n") if line.strip()]
        repeated.append(len(lines) - len(set(lines)))
    return {
        "n_words": np.diff(at),
        "word_chars": _sums(in_word & ((data & 0xC0) != 0x80), bounds),
        "n_symbols": _sums(SYMBOLS[data], bounds),
        "n_dup_lines": np.array(repeated, np.int64),
        "n_repeat_words": _sums(covered, at),
        "n_bytes": np.diff(bounds),
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes")


def _scored(docs: DataFrame, array, with_counts: bool) -> DataFrame:
    """``doc_id, lang, digest, q`` (what the grams of one array add) and, if wanted, the counts."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = HashArray(*array.value)
        for batch in pieces(batches):
            data, bounds = text_buffer(batch.column("text"))
            q = _sums(model.find(grams(data, bounds, batch.column("code").to_numpy())), bounds)
            out = {c: batch.column(c) for c in ("doc_id", "lang", "digest")} | {"q": pa.array(q)}
            if with_counts:
                out |= {c: pa.array(np.asarray(v, np.int64)) for c, v in text_counts(batch).items()}
            yield pa.RecordBatch.from_pydict(out)

    more = "".join(f", {c} long" for c in COUNTS) if with_counts else ""
    rows = docs.withColumn("digest", F.unhex(F.md5(F.encode("text", "UTF-8"))))
    return rows.mapInArrow(score, "doc_id long, lang string, digest binary, q long" + more)


def score_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, q`` and the counts of every row, under the model counted from all of them."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "lang", language_code(F.col("lang")).alias("code"), F.coalesce("text", F.lit("")).alias("text"))
    model = staged(kneser_ney(staged(count_grams(rows), "grams")), "model")
    arrays = max(1, math.ceil(model.count() / ARRAY_ENTRIES))
    result = None
    for i in range(arrays):
        # At most about ARRAY_ENTRIES of 12 bytes each: a proven bound.
        part = model.filter(F.pmod("gram", F.lit(arrays)) == i).toArrow()
        array = spark.sparkContext.broadcast(
            (part.column("gram").to_numpy().astype(np.uint64), part.column("q").to_numpy().astype(np.int32))
        )
        scored = _scored(rows, array, with_counts=result is None)
        if result is None:
            result = staged(scored, "scores")
            continue
        # Rows equal in doc_id, lang and text have equal sums, so one of them stands for all.
        more = scored.groupBy("doc_id", "lang", "digest").agg(F.max("q").alias("more"))
        same = [result[c].eqNullSafe(more[c]) for c in ("doc_id", "lang", "digest")]
        result = staged(result.join(more, same).select(result["*"], more["more"]).withColumn("q", F.col("q") + F.col("more")).drop("more"), "scores")
    return result


def bands(scores: DataFrame, width: float = 8.0, least: float = 0.05) -> DataFrame:
    """``lang, low, high``: bounds of the log perplexity a byte, from the quartiles of a language.

    ``low`` is the median less ``width`` times its distance to the first quartile, ``high`` the
    median plus as many times the distance to the third; a distance is ``least`` / width at least.
    """
    binned = scores.filter("logppl IS NOT NULL").groupBy("lang", F.floor(F.col("logppl") * 1000).alias("bin")).count()
    by_lang = Window.partitionBy("lang")
    upto = F.sum("count").over(by_lang.orderBy("bin")) / F.sum("count").over(by_lang)
    ranked = binned.withColumn("upto", upto)
    quartiles = ranked.groupBy("lang").agg(
        *[F.min(F.when(F.col("upto") >= share, F.col("bin"))).alias(name) for name, share in (("a", 0.25), ("m", 0.5), ("b", 0.75))]
    )
    reach = F.lit(least * 1000)
    return quartiles.select(
        "lang",
        ((F.col("m") - F.greatest((F.col("m") - F.col("a")) * width, reach)) / 1000).alias("low"),
        ((F.col("m") + 1 + F.greatest((F.col("b") - F.col("m")) * width, reach)) / 1000).alias("high"),
    )


def judge_documents(docs: DataFrame, width: float = 8.0) -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and ``perplexity`` (of a byte) of every row.

    A row is kept if it passes the base rules (50 words at least, no more than half of them in
    repeated 3-word windows) and its log perplexity lies in the band of its language; bands come
    from the rows that pass the base rules. Null languages are one language, a null text is empty.
    """
    scores = score_documents(docs).withColumn("logppl", F.when(F.col("n_bytes") > 0, -F.col("q") / SCALE / F.col("n_bytes")))
    scores = scores.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    limits = bands(scores.filter(~F.col("base_failed")), width).withColumnRenamed("lang", "band_lang")
    judged = scores.join(limits, scores["lang"].eqNullSafe(limits["band_lang"]), "left")
    inside = F.coalesce(F.col("logppl").between(F.col("low"), F.col("high")), F.lit(False))
    return judged.select(
        "doc_id",
        *[F.col(c) for c in COUNTS[:5]],
        "base_failed",
        (~F.col("base_failed") & inside).alias("kept"),
        F.exp("logppl").alias("perplexity"),
        F.exp("low").alias("lower_band"),
        F.exp("high").alias("upper_band"),
    )
