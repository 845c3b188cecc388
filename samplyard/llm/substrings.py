"""Substring deduplication with FM-indexes.

A window is ``length`` consecutive words of one document. A word goes if a window that covers it also
starts in a document with a smaller doc_id.

1. *Routes.* The least hash among the 5-word runs of a window is its route: a function of the window's
   words, so equal windows have equal routes wherever they are. Windows in a row with one route are a
   segment. Routes that two documents have are live; no other window can repeat across documents.
2. *Live segments.* A Bloom filter of the live routes (of bounded size) goes to all tasks; a second
   scan of the documents keeps the segments it lets pass. A false pass costs time, not truth.
3. *Index shards.* Live segments, each distinct one once with its least doc_id, are dealt by route to
   shards. A shard is a compressed FM-index over its segments' words; backward search over its
   wavelet tree finds the occurrences of every window, and the least doc_id among them is the answer.
4. *Removal.* Answers join the places of their segments; windows with a smaller doc_id become
   intervals, gathered per document (no longer than the document) and cut out of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplyard.llm.fmindex import SORTED, least_per_window
from samplyard.llm.tables import partitions, pieces, staged, text_buffer
from samplyard.llm.words import mix, run_hashes, word_hashes

WINDOW = 13
RUN = 5
#: Bits of the Bloom filter: 16 for each route, within these powers of two.
BLOOM_BITS = (16, 29)
NOBODY = (1 << 63) - 1


def _segments(batch: pa.RecordBatch, length: int):
    """Words (start, end, hash, first of each text) and segments: route, text, first word, windows."""
    starts, ends, hashes, at = word_hashes(*text_buffer(batch.column("text")))
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    none = np.zeros(0, np.int64)
    if len(hashes) < length:
        return starts, ends, hashes, at, np.zeros(0, np.uint64), none, none, none
    least = run_hashes(hashes, RUN)
    reach, want = 1, length - RUN + 1
    while reach < want:
        step = min(reach, want - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    places = np.flatnonzero(doc[: len(least)] == doc[length - 1 :])
    route = least[places]
    new = np.ones(len(places), bool)
    new[1:] = (route[1:] != route[:-1]) | (places[1:] != places[:-1] + 1)
    first = np.flatnonzero(new)
    windows = np.diff(np.concatenate([first, [len(places)]]))
    return starts, ends, hashes, at, route[first], doc[places[first]], places[first], windows


def _owners(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").fill_null(NOBODY).to_numpy(zero_copy_only=False)


def live_routes(docs: DataFrame, length: int = WINDOW) -> DataFrame:
    """``route`` of the segments that at least two doc_ids have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            _, _, _, _, route, doc, _, _ = _segments(batch, length)
            if not len(route):
                continue
            owner = _owners(batch)[doc]
            order = np.argsort(route)
            route, owner = route[order], owner[order]
            first = np.flatnonzero(np.concatenate([[True], route[1:] != route[:-1]]))
            yield pa.RecordBatch.from_pydict(
                {
                    "route": route[first].astype(np.int64),
                    "lo": np.minimum.reduceat(owner, first),
                    "hi": np.maximum.reduceat(owner, first),
                }
            )

    rows = docs.select("doc_id", "text").mapInArrow(run, "route long, lo long, hi long")
    return rows.groupBy("route").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo < hi").select("route")


class Bloom:
    """Two bits for each key in a bit vector of ``2 ** bits``."""

    def __init__(self, bits: int):
        self.bits = bits
        self.words = np.zeros(1 << (bits - 6), np.uint64)

    def places(self, keys: np.ndarray) -> np.ndarray:
        keys = mix(keys.astype(np.uint64))
        return np.concatenate([keys >> np.uint64(64 - self.bits), keys & np.uint64((1 << self.bits) - 1)])

    def add(self, keys: np.ndarray) -> None:
        places = self.places(keys)
        np.bitwise_or.at(self.words, (places >> np.uint64(6)).astype(np.int64), np.uint64(1) << (places & np.uint64(63)))

    def has(self, keys: np.ndarray) -> np.ndarray:
        places = self.places(keys)
        hit = (self.words[(places >> np.uint64(6)).astype(np.int64)] >> (places & np.uint64(63))) & np.uint64(1)
        return hit.reshape(2, -1).all(axis=0)


def bloom_filter(keys: DataFrame, column: str):
    """Broadcast Bloom filter of a long column; at most ``2 ** BLOOM_BITS[1]`` bits, a proven bound."""
    count = keys.count()
    bits = min(max((16 * count).bit_length(), BLOOM_BITS[0]), BLOOM_BITS[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Bloom(bits)
        for batch in batches:
            own.add(batch.column(column).to_numpy())
        used = np.flatnonzero(own.words)
        for at in range(0, len(used), 100_000):
            part = used[at : at + 100_000]
            yield pa.RecordBatch.from_pydict({"place": part.astype(np.int64), "word": own.words[part].astype(np.int64)})

    words = keys.select(column).mapInArrow(run, "place long, word long").groupBy("place").agg(F.bit_or("word").alias("word")).toArrow()
    whole = Bloom(bits)
    whole.words[words.column("place").to_numpy()] = words.column("word").to_numpy().astype(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(whole)


def _text_hashes(batch: pa.RecordBatch) -> np.ndarray:
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    return np.array([xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in texts], np.int64)


SCAN = "kind string, doc_id long, text_hash long, start long, segment long, shard int, lo long, hi long, body binary"


def _scan(docs: DataFrame, live, length: int, shards: int) -> DataFrame:
    """Two kinds of rows: ``place`` (a live segment in a document) and ``body`` (a distinct live segment
    of the task, with its least and greatest doc_id)."""
    names = [f.split()[0] for f in SCAN.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    kinds = [types[f.split()[1]] for f in SCAN.split(", ")]

    def rows(kind: str, count: int, **columns) -> pa.RecordBatch:
        arrays = [
            pa.array([kind] * count, pa.string()) if n == "kind" else pa.array(columns[n], t) if n in columns else pa.nulls(count, t)
            for n, t in zip(names, kinds)
        ]
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        routes = live.value
        bodies: dict[int, list] = {}

        def out():
            found = list(bodies.items())
            bodies.clear()
            for at in range(0, len(found), 5000):
                part = found[at : at + 5000]
                yield rows(
                    "body", len(part), segment=[s for s, _ in part], shard=[b[0] for _, b in part], lo=[b[1] for _, b in part],
                    hi=[b[2] for _, b in part], body=[b[3] for _, b in part],
                )

        for batch in pieces(batches):
            starts, ends, hashes, at, route, doc, first, windows = _segments(batch, length)
            if not len(route):
                continue
            marks = _text_hashes(batch)
            ids, owner = batch.column("doc_id"), _owners(batch)
            passed = np.flatnonzero(routes.has(route))
            route, doc, first, windows = route[passed], doc[passed], first[passed], windows[passed]
            data = text_buffer(batch.column("text"))[0].tobytes()
            last = first + windows + length - 2
            names64 = np.empty(len(first), np.int64)
            for i, (a, b) in enumerate(zip(first.tolist(), last.tolist())):
                body = b" ".join(data[starts[a] : ends[b]].split())
                name = xxhash.xxh3_64_intdigest(body) - (1 << 63)
                names64[i] = name
                known = bodies.get(name)
                who = int(owner[doc[i]])
                if known is None:
                    bodies[name] = [int(route[i] % np.uint64(shards)), who, who, body]
                else:
                    known[1], known[2] = min(known[1], who), max(known[2], who)
            yield rows(
                "place", len(first), doc_id=ids.take(pa.array(doc)), text_hash=marks[doc], start=first - at[doc],
                segment=names64, shard=(route % np.uint64(shards)).astype(np.int32),
            )
            if len(bodies) > 200_000:
                yield from out()
        yield from out()

    return docs.select("doc_id", "text").mapInArrow(run, SCAN)


def _answers(bodies: DataFrame, length: int) -> DataFrame:
    """``segment, shard, answer``: the least doc_id for each window of each distinct segment, for
    segments of which some window may have to go."""

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        grouped = pdf.groupby("segment", sort=True).agg(lo=("lo", "min"), hi=("hi", "max"), body=("body", "first"))
        raw = grouped["body"].tolist()
        bounds = np.concatenate([[0], np.cumsum([len(b) for b in raw], dtype=np.int64)])
        _, _, hashes, at = word_hashes(np.frombuffer(b"".join(raw), np.uint8), bounds)
        owners = grouped["lo"].to_numpy(np.int64)
        found = least_per_window([hashes[a:b] for a, b in zip(at[:-1], at[1:])], owners, length)
        latest = grouped["hi"].to_numpy(np.int64)
        useful = [i for i, f in enumerate(found) if f.min() < latest[i]]
        return pd.DataFrame(
            {
                "segment": grouped.index.to_numpy()[useful],
                "shard": np.full(len(useful), pdf["shard"].iloc[0], np.int32),
                "answer": [found[i].astype("<i8").tobytes() for i in useful],
            }
        )

    return bodies.groupBy("shard").applyInPandas(search, "segment long, shard int, answer binary")


def repeated_intervals(docs: DataFrame, length: int = WINDOW) -> DataFrame:
    """``doc_id, text_hash, start, stop``: runs of words whose windows also start in a document with
    a smaller doc_id; one for each run of windows of a segment, so they may overlap.

    ``docs``: ``doc_id`` and ``text`` without null texts.
    """
    if not RUN <= length <= SORTED:
        raise ValueError(f"a window has {RUN} to {SORTED} words")
    routes = staged(live_routes(docs, length), "routes")
    shards = 4 * partitions(docs.sparkSession)
    scanned = staged(_scan(docs, bloom_filter(routes, "route"), length, shards), "segments")
    answers = _answers(scanned.filter("kind = 'body'").select("segment", "shard", "lo", "hi", "body"), length)
    places = scanned.filter("kind = 'place' AND doc_id IS NOT NULL").select("doc_id", "text_hash", "start", "segment", "shard")

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "start", "answer")))
            out: list[tuple] = []
            for doc_id, mark, start, answer in rows:
                hits = np.flatnonzero(np.frombuffer(answer, "<i8") < doc_id)
                if len(hits):
                    cut = np.flatnonzero(np.diff(hits) > 1)
                    for a, b in zip([hits[0], *hits[cut + 1]], [*hits[cut], hits[-1]]):
                        out.append((doc_id, mark, start + int(a), start + int(b) + length))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], pa.int64()) for i in range(4)], ["doc_id", "text_hash", "start", "stop"]
            )

    joined = places.join(answers, ["segment", "shard"]).select("doc_id", "text_hash", "start", "answer")
    return joined.mapInArrow(cover, "doc_id long, text_hash long, start long, stop long")


def remove_repeats(docs: DataFrame, length: int = WINDOW) -> DataFrame:
    """Every row with ``n_words, n_removed, kept_sha256`` and, where words went, ``kept_text`` (the
    kept words joined by a space; null where nothing went). Own columns of these names are replaced.

    A null text counts as empty. A row without a doc_id is neither cut nor a reason to cut. Rows that
    share a doc_id are judged each by its own text; they don't cut each other.
    """
    docs = docs.drop("n_words", "n_removed", "kept_sha256", "kept_text", "text_hash", "runs")
    filled = docs.withColumn("text", F.coalesce("text", F.lit("")))
    intervals = repeated_intervals(filled.select("doc_id", "text"), length)
    # A document's intervals are no more than its words.
    runs = intervals.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    runs = staged(runs, "intervals")
    touched = bloom_filter(runs.select("doc_id"), "doc_id")
    columns = filled.columns

    def marked(batches: Iterator[pa.RecordBatch], wanted: bool) -> Iterator[pa.RecordBatch]:
        """Rows that may, or can't, have lost words."""
        changed = touched.value
        for batch in pieces(batches):
            hit = changed.has(_owners(batch).astype(np.int64)) == wanted
            if hit.any():
                yield batch.filter(pa.array(hit))

    def with_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in marked(batches, True):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_text_hashes(batch))], [*columns, "text_hash"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            counts, gone, digests, kept = [], [], [], []
            runs = batch.column("runs").to_pylist() if "runs" in batch.schema.names else [None] * batch.num_rows
            for text, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), runs):
                left = words = text.split()
                if spans:
                    keep = np.ones(len(words), bool)
                    for span in spans:
                        keep[span["start"] : span["stop"]] = False
                    left = [words[i] for i in np.flatnonzero(keep)]
                joined = b" ".join(left)
                counts.append(len(words))
                gone.append(len(words) - len(left))
                digests.append(hashlib.sha256(joined).hexdigest())
                kept.append(joined.decode() if spans else None)
            found = [pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), *found], [*columns, "n_words", "n_removed", "kept_sha256", "kept_text"]
            )

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in filled.schema.fields)
    result = own + ", n_words long, n_removed long, kept_sha256 string, kept_text string"
    # Only rows that may have lost words move with their text.
    moved = filled.mapInArrow(with_hash, own + ", text_hash long").join(runs, ["doc_id", "text_hash"], "left")
    stayed = filled.mapInArrow(lambda batches: cut(marked(batches, False)), result)
    return moved.select(*columns, "runs").mapInArrow(cut, result).unionByName(stayed)
