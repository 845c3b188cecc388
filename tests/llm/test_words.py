import re

import numpy as np
import pytest

from samplyard.llm import words

TEXTS = ["", "a", " a  b\tc\x0bd ", "日本 é\x1cx\x85y z", "x" * 5000, "w " * 3000, "same word same", "\n"]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


@pytest.mark.parametrize("stretch", [7, 64, 1 << 20])
def test_words_are_those_of_the_pattern(monkeypatch, stretch):
    monkeypatch.setattr(words, "STRETCH", stretch)
    raw = [t.encode() for t in TEXTS]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    data = b"".join(raw)
    starts, ends, hashes, at = words.word_hashes(np.frombuffer(data, np.uint8), bounds)
    seen = {}
    for i, text in enumerate(TEXTS):
        got = [data[s:e].decode() for s, e in zip(starts[at[i] : at[i + 1]], ends[at[i] : at[i + 1]])]
        assert got == split(text)
        for word, h in zip(got, hashes[at[i] : at[i + 1]]):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_hashes_do_not_depend_on_the_place():
    one = words.word_hashes(np.frombuffer(b"abc", np.uint8), np.array([0, 3]))[2][0]
    two = words.word_hashes(np.frombuffer(b"zz abc", np.uint8), np.array([0, 6]))[2][1]
    assert one == two


def test_shingles():
    h = words.seeded(6, 1)
    assert len(words.shingles(h, 3)) == 4
    assert len(words.shingles(h[:2], 3)) == 1
    assert len(words.shingles(h[:0], 3)) == 0
    assert words.shingles(h[:2], 3)[0] not in words.shingles(h, 3)
    assert len(words.shingles(np.tile(h[:1], 9), 3)) == 1
