import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from samplyard.llm import hilbert

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_word_encoder_equals_the_library():
    library, own = Tokenizer.from_file(PATH), hilbert.WordEncoder(PATH, limit=300)
    rng = random.Random(3)
    bits = ["The", "the,", "é", "É.", "don't", "<|endoftext|>", "<|ENDOFTEXT|>", "İx", "ﬁ", "J̌", "x1y2", "...", "a.b", "日本", " \u00a0", "\x85",
            "\u2028", "\x1c", "Straße!", "ΣΑΣ", "&&&", "a&&&", "'s", "they'll.", "ñ", "n̈", "Å", "\u212b", "9", "½", "ŉ", "K"]
    texts = []
    for _ in range(800):
        texts.append("".join(rng.choice(bits) + rng.choice(["", " ", "\n", "  ", "\t"]) for _ in range(rng.randrange(12))))
    got = [np.frombuffer(i, own.kind).tolist() for i in own.encode([t.encode() for t in texts])]
    for text, ids in zip(texts, got):
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_letter_and_closing_punctuation_equals_the_library():
    library, own = Tokenizer.from_file(PATH), hilbert.WordEncoder(PATH)
    texts = [f"{form}{end}" for c in map(chr, range(0x21, 0x250)) for form in (c, f"a{c}b", f"T{c}") for end in ("", "&&&", ",!!")]
    texts += [f"Wörd{a}{b}" for a in hilbert.TAIL for b in hilbert.TAIL] + ["", " ", "\n a  b\t", "a" * 70_000]
    for text, ids in zip(texts, own.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, own.kind).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert own.encode([]) == [] and own.encode([b""]) == [b""]


def test_words_of_letters_go_to_the_library_together_and_once(monkeypatch):
    alone, together = [], []
    library, plain = hilbert.WordEncoder._library, hilbert.WordEncoder._plain
    monkeypatch.setattr(hilbert.WordEncoder, "_library", lambda self, words: (alone.extend(words), library(self, words))[1])
    monkeypatch.setattr(hilbert.WordEncoder, "_plain", lambda self, words: (together.extend(words), plain(self, words))[1])
    own = hilbert.WordEncoder(PATH)
    for _ in range(2):
        own.encode(["Ción&&& CIÓN!! ción aiaux$$$ Aiaux, x1".encode()])
    assert sorted(together) == [b"aiaux", "ción".encode()]
    assert sorted(str(w) for w in alone if w not in ("x1", b"x1")) == sorted(str(t) for t in (b"&&&", b"!!", b"$$$", b","))


def test_common_words_are_still_known_when_too_many_others_came(monkeypatch):
    together, plain = [], hilbert.WordEncoder._plain
    monkeypatch.setattr(hilbert.WordEncoder, "_plain", lambda self, words: (together.extend(words), plain(self, words))[1])
    library, own = Tokenizer.from_file(PATH), hilbert.WordEncoder(PATH, limit=40)
    letters = "abcdefghij"
    for i in range(9):
        texts = ["the common, Words!", " ".join(f"q{letters[i]}{a}{letters[j]}" for a in letters[:2] for j in range(10))]
        for text, ids in zip(texts, own.encode([t.encode() for t in texts])):
            assert np.frombuffer(ids, own.kind).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert len(own.known) <= 40
    assert [together.count(w) for w in (b"the", b"common", b"words")] == [1, 1, 1]


def test_curve_visits_every_cell_and_neighbours_touch():
    for dims, bits in ((2, 3), (3, 2)):
        side = 1 << bits
        cells = np.array(np.meshgrid(*[np.arange(side)] * dims)).reshape(dims, -1).T
        keys = hilbert.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(side**dims))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check(cases, got, length):
    library = Tokenizer.from_file(PATH)
    want = sorted(
        ((r[0] is not None, r[0] or 0, np.array([*library.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")) for r in cases),
        key=lambda w: (w[0], w[1], w[2].tobytes()),
    )
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in got:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
        assert r["length"] > 0
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == length or at & (at - 1) == 0 and at <= length
    for known, doc_id, ids in want:
        mine = by_doc[doc_id if known else None]
        fits = [
            r for r in mine
            if r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
        ]
        assert sum(r["length"] for r in fits) >= len(ids)
    assert sum(r["length"] for r in got) == sum(len(w[2]) for w in want)


def test_pieces_against_the_library(documents, cases):
    for length in (2048, 64):
        check(cases, hilbert.pack(documents, PATH, length).collect(), length)


def test_copies_and_near_copies_are_neighbours(spark):
    rng = random.Random(6)
    groups = [[rng.choice("abcdefghij") * rng.randint(1, 5) for _ in range(200)] for _ in range(12)]
    rows = [(i, " ".join([*groups[i % 12], f"x{i}"])) for i in range(240)]
    df = hilbert.encoded(spark.createDataFrame(rows, "doc_id long, text string"), PATH)
    order = [r["doc_id"] % 12 for r in df.orderBy("key", "doc_id").collect()]
    assert sum(a != b for a, b in zip(order, order[1:])) < 60


def test_empty_table_and_clashing_columns(nothing, documents, cases):
    assert hilbert.pack(nothing, PATH).count() == 0
    clash = documents.withColumns({c: F.lit("x") for c in ("key", "ids", "start", "offset")})
    check(cases, hilbert.pack(clash, PATH).collect(), 2048)


def test_cells_are_those_of_the_full_matrix():
    rng = np.random.default_rng(5)
    ids = [rng.integers(0, 49_000, rng.integers(1, 400)).astype(np.uint16) for _ in range(1300)] + [np.zeros(1, np.uint16)]
    buckets, directions = hilbert.projection()
    counts = np.zeros((len(ids), hilbert.BUCKETS))
    for row, own in zip(counts, ids):
        np.add.at(row, buckets[own], 1)
    vectors = np.log1p(counts)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    want = ((np.clip(vectors @ directions, -3.999, 3.999) + 4.0) / 8.0 * (1 << hilbert.BITS)).astype(np.int64)
    got = hilbert.document_cells(ids)
    assert np.abs(got - want).max() <= 1 and (got == want).mean() > 0.999
    assert hilbert.document_cells([]).shape == (0, hilbert.DIMENSIONS)
