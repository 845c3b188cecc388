"""Packing along a space-filling curve.

A document's token ids are counted in hashed buckets; the unit vector of the damped counts is
projected to a few dimensions and these are cut into cells whose Hilbert key orders the documents.
Rows are range-sorted by that key (then doc_id and a hash of the ids, so many copies of one text spread over
tasks) and neighbouring documents are packed into sequences one after the other, cut where a
sequence is full. The rest of a task's stream is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

from samplyard.llm.tables import pieces, staged, text_buffer
from samplyard.llm.words import seeded

BUCKETS = 1024
#: Documents whose bucket counts are laid out at once, and text bytes whose words are looked up together.
BLOCK = 512
ENCODED_BYTES = 4 << 20
DIMENSIONS = 3
BITS = 10
END = 1
#: Words of these letters are the same for the library whether it normalizes them or finds them lower-cased.
LATIN = "^[A-Za-zÀ-ÖØ-öø-įı-ɏ]+$"
TAIL = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Words of letters that go to the library in one string.
TOGETHER = 200
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, hilbert_key long"
)


class WordEncoder:
    """Token ids of texts from those of their words, which the library encodes once in each call.

    Valid for tokenizers that drop white space and encode what stands between independently, letters
    apart from punctuation, lower-cased and byte by byte. Words of Latin letters, and such a word before
    closing punctuation, are lower-cased here, encoded many at a time without the library's normalizer
    and told apart by the pieces that end a word; all others go through the whole library one by one.

    Words and ids stay in Arrow columns: an object for each took most of the time and of the memory.
    Ids of words are kept for later calls, all of them up to ``limit``, then those of the call before.
    """

    def __init__(self, path: str, limit: int = 300_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = Tokenizer(self.tokenizer.model)  # the same model, not another copy of it
        self.letters.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.ends = np.zeros(size, bool)
        for piece, i in self.tokenizer.get_vocab().items():
            self.ends[i] = piece.endswith("</w>")
        self.limit = limit
        self.known, self.known_ids = pa.array([""]), pa.array([b""], pa.large_binary())

    def _library(self, words: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _plain(self, words: list[bytes]) -> pa.Array:
        """Ids of words of lower-case letters, many in one string."""
        out = [pa.array([], pa.large_binary())]
        for part in (words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)):
            # What the library makes of many parts would take much more memory than their ids.
            (found,) = self.letters.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)
            ids = np.array(found.ids, self.kind)
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) != len(part) or last[-1] != len(ids):
                out.append(pa.array(self._library(part), pa.large_binary()))
                continue
            stops = np.concatenate([[0], last]) * self.kind.itemsize
            out.append(pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(stops), pa.py_buffer(ids.tobytes())]))
        return pa.concat_arrays(out)

    def learn(self, words: pa.Array, letters: int) -> pa.Array:
        """Ids of distinct words, the first ``letters`` of which are of lower-case letters."""
        place = pc.index_in(words, self.known)
        new = place.is_null()
        first, other = (w.filter(n).cast(pa.binary()).to_pylist() for w, n in zip((words[:letters], words[letters:]), (new[:letters], new[letters:])))
        ids = pa.concat_arrays([self.known_ids, self._plain(first), pa.array(self._library(other), pa.large_binary())])
        fits = len(ids) <= self.limit
        if fits:
            self.known, self.known_ids = pa.concat_arrays([self.known, words.filter(new)]), ids
        new = new.to_numpy(zero_copy_only=False)
        ids = ids.take(pa.array(np.where(new, len(ids) - new.sum() - 1 + np.cumsum(new), place.fill_null(0))))
        if not fits:
            self.known, self.known_ids = words[: self.limit], ids[: self.limit]
        return ids

    def distinct(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words."""
        bases = pc.ascii_rtrim(words, TAIL)
        longer = pc.subtract(pc.binary_length(words), pc.binary_length(bases)).to_numpy()
        plain = pc.match_substring_regex(bases, LATIN).to_numpy(zero_copy_only=False) & (longer <= 8)
        letters = pc.utf8_lower(bases.filter(pa.array(plain))).dictionary_encode()
        # The bytes of a tail make one number; none of them is zero.
        data, ends = text_buffer(words)
        tails, longer = np.zeros(len(words), np.uint64), np.where(plain, longer, 0)
        for i in range(longer.max()):
            has = np.flatnonzero(longer > i)
            tails[has] |= data[ends[has + 1] - 1 - i].astype(np.uint64) << np.uint64(8 * i)
        tails, tail = np.unique(tails, return_inverse=True)
        tails = pa.array([int(t).to_bytes(8, "big").lstrip(b"\0") for t in tails], pa.binary()).cast(pa.string())
        alone = pa.concat_arrays([words.filter(pa.array(~plain)), tails])
        # A word alone may be a tail of others.
        alone = alone.dictionary_encode()
        place = alone.indices.to_numpy() + len(letters.dictionary)
        base = np.empty(len(words), np.int64)
        base[plain], base[~plain] = letters.indices.to_numpy(), place[: len(place) - len(tails)]
        ids = self.learn(pa.concat_arrays([letters.dictionary, alone.dictionary]), len(letters.dictionary))
        ends = ids.take(pa.array(place[len(place) - len(tails) :][tail]))
        return pc.binary_join_element_wise(ids.take(pa.array(base)), ends, pa.scalar(b"", pa.large_binary()))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        words = split.flatten().dictionary_encode()
        if not len(words):
            return [b""] * len(texts)
        # White space at an end of a text leaves an empty word, which has no ids.
        # One buffer holds the ids of all words in order; those of a text are a stretch of it.
        ids = self.distinct(words.dictionary).take(words.indices)
        ends, raw = np.frombuffer(ids.buffers()[1], np.int64), ids.buffers()[2]
        stops, raw = ends[split.offsets.to_numpy()].tolist(), raw.to_pybytes() if raw else b""
        return [raw[a:b] for a, b in zip(stops, stops[1:])]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers below ``2 ** bits`` (Skilling's
    transform: undo the excess turns from the highest bit down, then Gray-encode)."""
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(dims):
            turned = (x[:, i] & bit) != 0
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(turned, low, swap)
            if i:
                x[:, i] ^= swap
        bit >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where((x[:, dims - 1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


@lru_cache(maxsize=1)
def projection() -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every token number, and the direction of every bucket."""
    signs = (seeded(BUCKETS * DIMENSIONS, 8) >> np.uint64(11)).astype(np.float64) / 2.0**53
    directions = (signs.reshape(BUCKETS, DIMENSIONS) - 0.5) * np.sqrt(12.0)
    return (seeded(1 << 16, 7) >> np.uint64(54)).astype(np.int64), directions


def document_cells(ids: list[np.ndarray], bits: int = BITS) -> np.ndarray:
    """The cell of each document: its damped, unit-length bucket counts, projected and cut.

    Counts of a block of documents are laid out in full, those that are not zero are projected.
    """
    buckets, directions = projection()
    found = np.zeros((len(ids), DIMENSIONS))
    for first in range(0, len(ids), BLOCK):
        part = ids[first : first + BLOCK]
        doc = np.repeat(np.arange(len(part)) * BUCKETS, [len(i) for i in part])
        counts = np.bincount(doc + buckets[np.concatenate(part) & 0xFFFF])
        at = np.flatnonzero(counts)
        weights, own, bucket = np.log1p(counts[at]), at // BUCKETS, at % BUCKETS
        size = np.sqrt(np.bincount(own, weights * weights, len(part)))
        for d in range(DIMENSIONS):
            found[first : first + BLOCK, d] = np.bincount(own, weights * directions[bucket, d], len(part)) / np.maximum(size, 1e-9)
    places = (np.clip(found, -3.999, 3.999) + 4.0) / 8.0
    return (places * (1 << bits)).astype(np.int64)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, key, ids``: Hilbert key and packed token ids (with the closing one) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        words = encoder(path)
        close = np.array([END], words.kind).tobytes()
        for batch in pieces(batches, ENCODED_BYTES):
            found = [ids + close for ids in words.encode(batch.column("text").cast(pa.binary()).to_pylist())]
            cells = document_cells([np.frombuffer(f, words.kind) for f in found])
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "key": hilbert_keys(cells), "ids": found})

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, key long, ids binary")


def pack(docs: DataFrame, path: str, length: int = 2048) -> DataFrame:
    """One row for each piece of a document in a sequence; every id lies in exactly one piece.

    A null text counts as empty and still has the closing id. Repeated rows are packed each. No
    sequence is padded: all are full but those of the rest of a task's stream, which are powers of two.
    """
    width = encoder(path).kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in PIECES.split(", ")]
        sequence = TaskContext.get().partitionId() << 40
        open_pieces: list[tuple] = []  # (doc_id, start, ids, doc_tokens, key) of the sequence being filled
        filled = 0
        rows: list[tuple] = []

        def close(parts):
            nonlocal sequence
            at = 0
            for doc_id, start, ids, tokens, key in parts:
                rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), tokens, sequence, at, key))
                at += len(ids)
            sequence += 1

        def flush():
            found = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
            rows.clear()
            return found

        for batch in batches:
            for doc_id, key, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "key", "ids"))):
                ids = np.frombuffer(raw, width)
                start = 0
                while start < len(ids):
                    part = ids[start : start + length - filled]
                    open_pieces.append((doc_id, start, part, len(ids), key))
                    filled += len(part)
                    start += len(part)
                    if filled == length:
                        close(open_pieces)
                        open_pieces, filled = [], 0
                if len(rows) >= 10_000:
                    yield flush()
        while filled:
            size = 1 << (filled.bit_length() - 1)
            now, later, room = [], [], size
            for doc_id, start, ids, tokens, key in open_pieces:
                head, rest = ids[:room], ids[room:]
                if len(head):
                    now.append((doc_id, start, head, tokens, key))
                if len(rest):
                    later.append((doc_id, start + len(head), rest, tokens, key))
                room -= len(head)
            close(now)
            open_pieces, filled = later, filled - size
        if rows:
            yield flush()

    rows = staged(encoded(docs, path), "ids")
    # The sample that sets the ranges goes to the driver: its columns are numbers, not ids.
    order = ["key", "doc_id", F.xxhash64("ids")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, PIECES)
