import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from samplyard.llm import paritysketch as S
from samplyard.llm.components import components


def shingle_set(text):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2)))


def brute(rows):
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] == sets[j]
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and (same_id or 100 * common >= 90 * len(sets[i] | sets[j])):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            root = find(i)
            least[root] = min(least.get(root, r[0]), r[0])
    return Counter((r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(rows))


def test_against_brute_force(documents, cases):
    got = S.near_groups(documents).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(cases)


@pytest.mark.parametrize("block", [1000, 7])
def test_a_large_group_of_near_copies(spark, monkeypatch, block):
    """Chains and strays: many documents near enough to some others only."""
    monkeypatch.setattr(S, "BLOCK", block)
    rng = random.Random(1)
    base = [f"b{i}" for i in range(90)]
    rows = []
    for i in range(150):
        text = list(rows[rng.randrange(len(rows))][1].split()) if i % 3 == 0 and rows else list(base)
        for _ in range(rng.randrange(0, 5)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(50)}"
        if i % 5 == 0:
            text += [f"t{rng.randrange(9)}"] * rng.randrange(4)
        rows.append((i, " ".join(text)))
    got = S.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute(rows)
    assert len({k[2] for k in want}) > 5
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want


def test_every_linked_pair_shares_a_key():
    """The pigeonhole bound at its edge, over many sizes."""
    rng = np.random.default_rng(6)
    for size in [1, 2, 5, 9, 10, 11, 19, 20, 38, 57, 76, 95, 100, 190, 400, 1000]:
        for _ in range(30):
            a = np.unique(rng.integers(1, 1 << 62, size).astype(np.uint64))
            drop = int(rng.integers(0, len(a) // 10 + 1))
            add = int(rng.integers(0, len(a) // 10 + 2))
            b = np.unique(np.concatenate([a[drop:], rng.integers(1, 1 << 62, add).astype(np.uint64)]))
            common = len(np.intersect1d(a, b))
            if not len(b) or not S.linked(common, len(a), len(b)):
                continue
            band = max(S.band_of(len(a)), S.band_of(len(b)))
            assert band in S.bands_of(len(a)) and band in S.bands_of(len(b))
            (fa, ka), (fb, kb) = S.sketch(a, band), S.sketch(b, band)
            assert len(np.intersect1d(ka, kb))
            apart = (int.from_bytes(fa, "little") ^ int.from_bytes(fb, "little")).bit_count()
            assert apart <= len(a) + len(b) - 2 * common


def test_components(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(0, 60)] + [(200, i) for i in range(201, 240)] + [(300, 301), (301, 300), (5, 5)]
    links += [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(40)]
    parent = {x: x for pair in links for x in pair}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in linked}


def test_empty_table_and_clashing_columns(nothing, documents):
    assert S.near_groups(nothing).count() == 0
    clash = documents.withColumns({c: F.lit("x") for c in ("rep", "band", "key", "class", "component", "d1", "id")})
    assert S.near_groups(clash).count() == documents.count()


def brute_of(rows, words, percent):
    """As ``brute``, for shingles of any length and any similarity."""
    sets = []
    for r in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in r[1] or ""))
        sets.append(frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))) if found else frozenset())
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] == sets[j]
            if sets[i] and sets[j] and (same_id or 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])):
                a, b = label[i], label[j]
                label = [a if x == b else x for x in label]
    least = {}
    for r, root in zip(rows, label):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    return Counter((r[0], len(s), least.get(root)) for r, s, root in zip(rows, sets, label))


def edited_texts(seed=3):
    """Texts of several lengths with copies on both sides of a similarity of 0.8."""
    rng = random.Random(seed)
    rows = []
    for n in (6, 20, 60, 130, 500):
        base = [f"b{rng.randrange(10**6)}" for _ in range(n)]
        for i in range(25):
            text = list(base)
            for _ in range(rng.randrange(0, 2 + n // 30)):
                text[rng.randrange(n)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text[: n - rng.randrange(0, 1 + n // 20)])))
    return rows


@pytest.mark.parametrize("words,percent", [(5, 80), (2, 70), (3, 90)])
def test_other_words_and_similarities(spark, documents, cases, words, percent):
    got = S.near_groups(documents, words, percent).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_of(cases, words, percent)
    rows = edited_texts()
    got = S.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), words, percent).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_of(rows, words, percent)


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_every_linked_pair_shares_a_key_at_other_similarities(percent):
    rng = np.random.default_rng(percent)
    checked = 0
    for size in [1, 2, 5, 9, 10, 18, 19, 36, 45, 90, 100, 190, 400, 1000]:
        for _ in range(40):
            a = np.unique(rng.integers(1, 1 << 62, size).astype(np.uint64))
            gone = size * (100 - percent) // 100
            drop, add = int(rng.integers(0, gone + 1)), int(rng.integers(0, gone + 2))
            b = np.unique(np.concatenate([a[drop:], rng.integers(1, 1 << 62, add).astype(np.uint64)]))
            common = len(np.intersect1d(a, b))
            if not len(b) or not S.linked(common, len(a), len(b), percent):
                continue
            checked += 1
            band = max(S.band_of(len(a)), S.band_of(len(b)))
            assert band in S.bands_of(len(a), percent) and band in S.bands_of(len(b), percent)
            (fa, ka), (fb, kb) = S.sketch(a, band, percent), S.sketch(b, band, percent)
            assert len(np.intersect1d(ka, kb))
            apart = (int.from_bytes(fa, "little") ^ int.from_bytes(fb, "little")).bit_count()
            assert S.may_link(apart, len(a), len(b), percent)
    assert checked > 100
