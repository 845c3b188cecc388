import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from samplyard.llm import resync

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_against_the_library(documents, cases):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for chunk, overlap in ((16_384, 256), (100, 10)):
        got = resync.token_counts(documents, PATH, 100, chunk, overlap).collect()
        want = sorted(
            (str(r[0]), len((r[1] or "").encode()), len(model.encode(r[1] or "")), len(model.encode(r[1] or "")) > 100) for r in cases
        )
        assert sorted((str(r[0]), *r[1:]) for r in got) == want


def test_random_texts_with_small_chunks():
    model = resync.load_model(PATH)
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "é", "日", "<s>", "▁", "ing", "the ", "\t", "\u0301", "ﬁ", "①", "  \n"]
    for _ in range(600):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(150)))
        chunk = rng.randint(5, 40)
        assert resync.count_tokens(model, text, chunk, rng.randint(1, chunk - 1)) == len(model.encode(text)), repr(text)


def test_text_without_any_stable_boundary():
    model = resync.load_model(PATH)
    for text in ("x" * 5000, "ab" * 3000 + " end", " " * 4000, "日本語" * 900):
        assert resync.count_tokens(model, text, 300, 20) == len(model.encode(text))


def test_bad_overlap_empty_table_and_clashing_columns(nothing, documents):
    with pytest.raises(ValueError, match="shorter"):
        resync.count_tokens(resync.load_model(PATH), "a b " * 100, 10, 10)
    assert resync.token_counts(nothing, PATH).count() == 0
    clash = documents.withColumns({c: F.lit("x") for c in ("n_bytes", "n_tokens")})
    assert resync.token_counts(clash, PATH).count() == documents.count()
