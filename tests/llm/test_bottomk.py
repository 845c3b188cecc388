import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from samplyard.llm import bottomk


def shingle_set(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


@pytest.mark.parametrize("size", [4096, 64])
def test_against_brute_force(documents, cases, size):
    order = sorted(((r[0] is not None, r[0] or 0, r[1] or "") for r in cases))
    want = []
    for i, (known, doc_id, text) in enumerate(order):
        following = order[(i + 1) % len(order)][2]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = shingle_set(text), shingle_set(edited), shingle_set(following)
        want.append((doc_id if known else None, len(text), hashlib.sha256(edited.encode()).hexdigest(), jaccard(a, b), jaccard(a, c), len(a)))
    got = bottomk.fingerprints(documents, size).collect()
    assert len(got) == len(want)
    found = sorted(got, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["edited_sha256"]))
    want.sort(key=lambda w: (w[0] is not None, w[0] or 0, w[2]))
    errors = []
    for g, w in zip(found, want):
        assert (g["doc_id"], g["n_chars"], g["edited_sha256"]) == w[:3]
        errors += [abs(g["near_edited"] - w[3]), abs(g["near_next"] - w[4])]
        if size == 4096:
            assert max(errors[-2:]) < 1e-9 or w[5] > size
        assert abs(g["distinct_shingles"] - w[5]) <= 0.6 * w[5]
    assert np.mean(errors) < 0.02
    by_text = {}
    texts = {(r[0], r[1] or "") for r in cases}
    for g in found:
        for doc_id, text in texts:
            if doc_id == g["doc_id"]:
                assert by_text.setdefault(text, g["fingerprint"]) == g["fingerprint"]


def test_sketch_algebra():
    rng = random.Random(3)
    a = np.unique(np.array([rng.getrandbits(64) for _ in range(3000)], np.uint64))
    b = np.unique(np.concatenate([a[::2], np.array([rng.getrandbits(64) for _ in range(1000)], np.uint64)]))
    k = 512
    sa, sb = a[:k], b[:k]
    assert (bottomk.merge(sa, sb, k) == np.union1d(a, b)[:k]).all()
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(bottomk.resemblance(sa, sb, k) - true) < 0.08
    assert abs(bottomk.containment(sa, sb, k) - len(np.intersect1d(a, b)) / len(a)) < 0.12
    assert abs(bottomk.distinct_count(sa, k) / len(a) - 1) < 0.15
    assert (bottomk.decode(bottomk.encode(sa)) == sa).all()
    none = a[:0]
    assert bottomk.resemblance(none, none) == 1.0 and bottomk.resemblance(none, sa) == 0.0


def test_group_sketches(documents, cases):
    got = {r["source"]: bottomk.decode(r["fingerprint"]) for r in bottomk.group_sketches(documents, "source", 64).collect()}
    for source in {r[3] for r in cases}:
        whole = bottomk.sketches([(r[1] or "").encode() for r in cases if r[3] == source], 10**6)
        assert (got[source] == np.unique(np.concatenate(whole))[:64]).all()


def test_small_tables(nothing, spark, documents):
    assert bottomk.fingerprints(nothing).count() == 0
    one = spark.createDataFrame([(4, "a b c d e f g")], "doc_id long, text string")
    (row,) = bottomk.fingerprints(one).collect()
    assert row["near_next"] == 1.0
    clash = documents.withColumns({c: F.lit("x") for c in ("block", "tail", "place", "fingerprint", "first")})
    assert bottomk.fingerprints(clash).count() == documents.count()
