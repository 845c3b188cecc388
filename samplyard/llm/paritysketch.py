"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct shingles of ``words`` words (A-Z lower-cased). Two sets of a and b
members have a Jaccard similarity of p percent at least exactly if they differ in at most
(a + b) * (100 - p) / (100 + p) members: (a + b) / 19 for 90, (a + b) / 9 for 80.

* **Size bands.** Sizes are cut into bands, each a third wider than the one before. A pair is joined
  in the band of its larger set; a set that a set of a later band may link with also stands there.
* **Sketch.** In a band of largest size U, members are dealt by hash into d + 1 + s parts, d being what
  two sets of U members may differ in.
  Each member flips one of the 64 bits of its part: the Hamming distance of two sketches is a lower
  bound of the number of differing members.
* **Pigeonhole.** A linked pair differs in at most d members, so at least 1 + s parts are equal. Sets
  are joined on the values of their parts (parity word and XOR of the member hashes). A part of few
  members says little: in the order of size and value, a set's first s parts are no keys. It loses no
  pair: the last of the equal parts has s others before it in both sets.
* **Stars, then the rest.** In a group of equal keys every set is compared with the least one; this
  settles most of a group of near copies. Groups that still lie in several components are compared
  block by block inside tasks, only across components, and only pairs whose sketches are near
  enough leave the task.
* **Verify.** Candidate pairs are counted out on their whole texts.

Equal sets are collapsed first, by their digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from samplyard.llm.components import components
from samplyard.llm.tables import pieces, release, staged, text_buffer
from samplyard.llm.words import mix, run_hashes, seeded, shingles, word_hashes
from samplyard.session import work_path

#: Words of a shingle, and the similarity that links, unless others are asked for.
WORDS = 3
PERCENT = 90
#: Sets of one side of a block compared inside a task.
BLOCK = 1000

_edges = [1]
while _edges[-1] < 1 << 40:
    _edges.append(-(-_edges[-1] * 4 // 3))
EDGES = np.array(_edges, np.int64)
SEEDS = seeded(len(EDGES), 21)


def band_of(size: int) -> int:
    return int(np.searchsorted(EDGES, size))


def bands_of(size: int, percent: int = PERCENT) -> list[int]:
    """The set's own band, and the following ones if a set there may link with it."""
    bands = [band_of(size)]
    while 100 * size >= percent * (int(EDGES[bands[-1]]) + 1):
        bands.append(bands[-1] + 1)
    return bands


def part_counts(band: int, percent: int = PERCENT) -> tuple[int, int]:
    """Number of parts of a band, and how many of them may be weak: more of them where parts are small."""
    most = 2 * int(EDGES[band]) * (100 - percent) // (100 + percent)
    spare = 1 + most // (16 if percent >= 90 else 4)
    return most + 1 + spare, spare


def sketch(members: np.ndarray, band: int, percent: int = PERCENT) -> tuple[bytes, np.ndarray]:
    """The parity words folded to a byte for each part, and the join keys.

    ``members``: sorted distinct hashes. Folding a word is XOR of its bytes, so the distance of
    folded sketches is a lower bound too.
    """
    parts, spare = part_counts(band, percent)
    spread = mix(members ^ SEEDS[band])
    part = ((spread >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    order = np.argsort(part, kind="stable")
    part, spread = part[order].astype(np.int64), spread[order]
    first = np.flatnonzero(np.diff(part, prepend=-1))
    sizes = np.bincount(part, minlength=parts)
    words, values = np.zeros(parts, np.uint64), np.zeros(parts, np.uint64)
    bits = np.uint64(1) << (spread & np.uint64(63))
    words[part[first]] = np.bitwise_xor.reduceat(bits, first)
    values[part[first]] = np.bitwise_xor.reduceat(mix(spread), first)
    folded = np.bitwise_xor.reduce(words.view(np.uint8).reshape(parts, 8), axis=1)
    keys = mix(words + mix(values) + SEEDS[band] + np.arange(parts, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return folded.tobytes(), keys[np.lexsort((keys, sizes))[spare:]]


def linked(common: int, a: int, b: int, percent: int = PERCENT) -> bool:
    return 100 * common >= percent * (a + b - common)


def may_link(apart, a, b, percent: int):
    """Whether sets of ``a`` and ``b`` members that differ in ``apart`` at least may link; also for arrays."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    return (100 * low >= percent * high) & ((100 + percent) * apart <= (100 - percent) * (a + b))


def _shingle_sets(batch: pa.RecordBatch, words: int, column: str = "text") -> list[np.ndarray]:
    data, bounds = text_buffer(batch.column(column))
    lower = data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
    _, _, hashes, at = word_hashes(lower, bounds)
    runs = run_hashes(hashes, words)
    return [shingles(hashes[a:b], words, runs[a : max(a, b - words + 1)]) for a, b in zip(at[:-1], at[1:])]


def profiles(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """A row for each row of ``docs`` and band it stands in: ``doc_id, n_shingles, d1, d2`` (digest of
    the set), ``main`` (its own band), ``band, sketch, keys``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out: dict[str, list] = {c: [] for c in ("doc_id", "n_shingles", "d1", "d2", "main", "band", "sketch", "keys")}
            for doc_id, members in zip(batch.column("doc_id").to_pylist(), _shingle_sets(batch, words)):
                size = len(members)
                d1 = int(np.bitwise_xor.reduce(mix(members))) if size else 0
                d2 = int(np.add.reduce(mix(members ^ SEEDS[0]))) if size else 0
                for i, band in enumerate(bands_of(size, percent) if size else [0]):
                    folded, keys = sketch(members, band, percent) if size else (b"", np.zeros(0, np.uint64))
                    row = (doc_id, size, d1 - (1 << 63), d2 - (1 << 63), i == 0, band, folded, keys.astype(np.int64))
                    for column, value in zip(out.values(), row):
                        column.append(value)
            yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, n_shingles long, d1 long, d2 long, main boolean, band int, sketch binary, keys array<long>"
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        lambda batches: (b.cast(ARROW) for b in run(batches)), schema
    )


ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("main", pa.bool_()),
     ("band", pa.int32()), ("sketch", pa.binary()), ("keys", pa.list_(pa.int64()))]
)


def near_sketches(pairs: DataFrame, sketches: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Distinct ``a, b`` of the pairs (``a, b, band``) whose sizes and sketches allow a link."""

    def side(name):
        return sketches.select(F.col("doc_id").alias(name), "band", F.col("n_shingles").alias(f"n{name}"), F.col("sketch").alias(f"s{name}"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist())
            apart = [(int.from_bytes(x, "little") ^ int.from_bytes(y, "little")).bit_count() for x, y in sides]
            hits = may_link(np.array(apart, np.int64), batch.column("na").to_numpy(), batch.column("nb").to_numpy(), percent)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(hits, pa.bool_()))

    both = pairs.join(side("a"), ["a", "band"]).join(side("b"), ["b", "band"])
    return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(keep, "a long, b long").distinct()


def verified(pairs: DataFrame, texts: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The pairs (``a, b``) whose sets are similar enough, counted on their texts."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("ta").nbytes + batch.column("tb").nbytes
            step = max(1, int(batch.num_rows * (1 << 20) / max(size, 1)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                hits = [
                    linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent)
                    for x, y in zip(_shingle_sets(part, words, "ta"), _shingle_sets(part, words, "tb"))
                ]
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(hits, pa.bool_()))
        pa.default_memory_pool().release_unused()

    def side(name):
        return texts.select(F.col("doc_id").alias(name), F.col("text").alias(f"t{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(check, "a long, b long").distinct()


def _open_pairs(members: DataFrame, labels: DataFrame, sketches: DataFrame, folder: str, percent: int = PERCENT) -> DataFrame:
    """Pairs (``a, b``) across components that share a key and whose sketches are near.

    Groups whose members are all in one component are settled, and so are pairs with the group's
    least member. Members outside its component are compared with all others, in blocks.
    """
    named = members.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    named = named.withColumn("component", F.coalesce("component", "doc_id"))
    main = named.filter("doc_id = rep").select("key", F.col("component").alias("main"))
    stray = F.col("component") != F.col("main")
    joined = staged(named.join(main, "key").withColumn("stray", stray), "open-members", folder)
    groups = joined.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.col("stray").cast("long")).alias("strays"))
    # A group of two was compared as a star; one without strays is settled.
    groups = groups.filter("n > 2 AND strays > 0").select(
        "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("n_blocks"), F.ceil(F.col("strays") / BLOCK).cast("int").alias("s_blocks")
    )
    sides = joined.join(groups, "key").filter("doc_id <> rep").join(sketches.select("doc_id", "band", "n_shingles", "sketch"), ["doc_id", "band"])
    place = F.xxhash64("doc_id")
    left = sides.filter("stray").select(
        "key", F.pmod(place, "s_blocks").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("j"),
        F.lit(True).alias("left"), "doc_id", "component", "n_shingles", "sketch",
    )
    right = sides.select(
        "key", F.explode(F.sequence(F.lit(0), F.col("s_blocks") - 1)).alias("i"), F.pmod(place, "n_blocks").cast("int").alias("j"),
        F.lit(False).alias("left"), "doc_id", "component", "n_shingles", "sketch",
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        def arrays(rows):
            flat = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1)
            return rows["doc_id"].to_numpy(), rows["component"].to_numpy(), rows["n_shingles"].to_numpy(), flat

        chosen = pdf["left"].to_numpy(bool)
        if chosen.all() or not chosen.any():
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        ids, comps, sizes, bits = arrays(pdf[~chosen])
        found: list[tuple[int, int]] = []
        for doc_id, comp, size, own in zip(*arrays(pdf[chosen])):
            apart = np.bitwise_count(bits ^ own).sum(axis=1, dtype=np.int64)
            hit = (comps != comp) & may_link(apart, sizes, size, percent)
            found += [(min(doc_id, o), max(doc_id, o)) for o in ids[hit]]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return left.unionByName(right).groupBy("key", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def near_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: the least doc_id that links reach.

    Sets of shingles of ``words`` words link if they are ``percent`` percent alike at least. A text
    without words has an empty set and links with nothing; one of fewer words than a shingle has is
    one shingle. Null texts count as empty. Rows with one doc_id are one document, which has the
    links of each of them; a row without a doc_id takes part only through rows with the same set.
    """
    spark, folder = docs.sparkSession, work_path(docs.sparkSession, "near-copies")
    rows = staged(profiles(docs, words, percent), "profiles", folder)
    whole = staged(rows.filter("main").select("doc_id", "n_shingles", "d1", "d2"), "whole", folder)
    reps = staged(whole.filter("n_shingles > 0").groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep")), "reps", folder)
    single = reps.filter("rep IS NOT NULL").select(F.col("rep").alias("doc_id"))
    own = rows.filter("n_shingles > 0").join(single, "doc_id", "left_semi")
    keyed = own.select("doc_id", "band", F.explode("keys").alias("key"))
    # One exchange of the keys, which are by far the most rows; a group's rows are three numbers each.
    same = Window.partitionBy("key")
    shared = keyed.withColumns({"rep": F.min("doc_id").over(same), "last": F.max("doc_id").over(same)}).filter("rep < last")
    members = staged(shared.drop("last").distinct(), "members", folder)
    sketches = rows.filter("n_shingles > 0").select("doc_id", "band", "n_shingles", "sketch")
    needed = members.select("doc_id").distinct()
    sketches = staged(sketches.join(needed, "doc_id", "left_semi").distinct(), "sketches", folder)
    release(spark, folder, "profiles")
    stars = members.filter("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"), "band").distinct()
    # Candidates are written before they meet the texts: only texts of candidates are shuffled.
    near = staged(near_sketches(stars, sketches, percent), "near-stars", folder)
    links = staged(verified(near, _texts_of(docs, near), words, percent), "links", folder)
    open_pairs = staged(_open_pairs(members, components(links), sketches, folder, percent), "open-pairs", folder)
    release(spark, folder, "open-members", "members", "sketches", "near-stars")
    rest = verified(open_pairs, _texts_of(docs, open_pairs), words, percent)
    labels = components(links.unionByName(rest))
    classes = reps.join(labels, reps["rep"] == labels["id"], "left").select("d1", "d2", "n_shingles", F.coalesce("component", "rep").alias("class"))
    placed = whole.join(classes, ["d1", "d2", "n_shingles"], "left")
    return placed.select("doc_id", "n_shingles", F.coalesce("class", "doc_id").alias("component_id"))


def _texts_of(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``doc_id, text`` of the documents in the pairs (``a, b``)."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(ids, "doc_id", "left_semi")
