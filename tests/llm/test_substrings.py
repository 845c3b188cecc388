import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from samplyard.llm import fmindex, substrings


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, length):
    first = {}
    for doc_id, text, *_ in rows:
        words = split(text)
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            if doc_id is not None:
                first[window] = min(first.get(window, doc_id), doc_id)
    out = Counter()
    for doc_id, text, *_ in rows:
        words = split(text)
        gone = set()
        for i in range(len(words) - length + 1):
            if doc_id is not None and first[tuple(words[i : i + length])] < doc_id:
                gone.update(range(i, i + length))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[(doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("length", [13, 6])
def test_against_brute_force(documents, cases, length):
    got = substrings.remove_repeats(documents, length).collect()
    want = brute(cases, length)
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == want
    assert sum(k[2] for k in want) > 1000
    for r in got:
        assert (r["kept_text"] is None) == (r["n_removed"] == 0)


def test_random_texts_of_few_words(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(f"{rng.randrange(3)}" for _ in range(rng.randrange(60)))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substrings.remove_repeats(df, 7).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == brute(rows, 7)


def test_one_passage_in_very_many_documents(spark):
    rng = random.Random(2)
    passage = " ".join(f"p{rng.randrange(99)}" for _ in range(40))
    rows = [(i, f"{i} a{i} b{i} {passage} z{i}") for i in range(600)]
    got = {r["doc_id"]: r["n_removed"] for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got.pop(0) == 0 and set(got.values()) == {40}


def test_empty_table_clashing_columns_and_window_limits(nothing, documents):
    assert substrings.remove_repeats(nothing).count() == 0
    clash = documents.withColumns({c: F.lit("x") for c in ("n_words", "runs", "text_hash", "route", "maybe_not")})
    out = substrings.remove_repeats(clash)
    assert out.count() == documents.count() and "maybe_not" in out.columns
    with pytest.raises(ValueError, match="window"):
        substrings.remove_repeats(documents, 17)


def test_fm_index_counts_and_finds():
    rng = np.random.default_rng(4)
    tokens = np.concatenate([rng.integers(1, 9, 400), [0], rng.integers(1, 9, 200), [0]])
    index = fmindex.FMIndex(tokens)
    for length in (1, 2, 3, 4, 9):
        where = defaultdict(list)
        for i in range(len(tokens) - length + 1):
            where[tuple(tokens[i : i + length])].append(i)
        starts = np.array([p[0] for g, p in where.items() if 0 not in g])
        low, high = index.search(tokens, starts, length)
        for s, a, b in zip(starts, low, high):
            places = where[tuple(tokens[s : s + length])]
            if len(places) > 1:
                assert sorted(index.places[a:b]) == places
            else:
                assert b - a == 1


def test_wavelet_tree_ranks():
    rng = np.random.default_rng(1)
    for size in (2, 5, 70):
        symbols = rng.integers(0, size, 1000)
        tree = fmindex.WaveletTree(symbols, size)
        for c in range(size):
            places = rng.integers(0, 1001, 20)
            assert (tree.rank(np.full(20, c), places) == [np.count_nonzero(symbols[:p] == c) for p in places]).all()
