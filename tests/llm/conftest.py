import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def rows_with_cases():
    """Documents with copies, near copies, shared passages, nulls, ties, short and long texts."""
    rng = random.Random(7)
    rows, texts = [], []
    for _ in range(60):
        texts.append(" ".join(words(rng, rng.randrange(1, 160))))
    long = " ".join(words(rng, 6000, 3000))
    passage = " ".join(words(rng, 60))
    texts += [long, long, "", " \n\t ", "one", "two words", "A b C", "a B c", "x" * 3000]
    for i in range(8):
        texts.append(" ".join(words(rng, 30)) + " " + passage + "\n" + " ".join(words(rng, i)))
    base = words(rng, 150, 5000)
    for i in range(30):
        edited = list(base)
        for _ in range(rng.randrange(0, 9)):
            edited[rng.randrange(len(edited))] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(edited))
    texts += [texts[3]] * 12 + [texts[5]] * 2
    texts += ["repeat me now " * 40, "line one\nline two\nline one\n\n \nline one", "é ü 日本 ﬁ ½ a&&& b### c"]
    for i, text in enumerate(texts):
        rows.append((i * 3, text, ["en", "de", None][i % 3], "hot" if i % 3 else f"s{i % 4}", len(text)))
    rows.append((1000, None, None, None, None))
    rows.append((1001, None, "en", "s1", 0))
    rows.append((None, texts[5], "en", "s1", 3))
    rows.append(rows[4])
    return rows


@pytest.fixture(scope="session")
def cases():
    return rows_with_cases()


@pytest.fixture(scope="session")
def documents(spark, cases):
    return spark.createDataFrame(cases, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
