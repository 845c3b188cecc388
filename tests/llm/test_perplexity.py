import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from samplyard.llm import perplexity as P


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def base(text):
    words = split(text)
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {i + j for places in windows.values() if len(places) > 1 for i in places for j in range(3)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if split(line):
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dups, len(covered)


def model_of(rows):
    """Interpolated modified Kneser-Ney over bytes, written out from its definition."""
    levels = {P.ORDER: Counter()}
    for lang, text in rows:
        raw = bytes(P.ORDER - 1) + text.encode()
        for i in range(len(raw) - P.ORDER + 1):
            levels[P.ORDER][(lang, raw[i : i + P.ORDER])] += 1
    for size in range(P.ORDER - 1, 0, -1):
        levels[size] = Counter((lang, g[1:]) for lang, g in levels[size + 1])
    below = None
    for size in range(1, P.ORDER + 1):
        level = levels[size]
        times = Counter(level.values())
        d = P.discounts([times[r] for r in (1, 2, 3, 4)])
        total, cut = Counter(), Counter()
        for (lang, g), n in level.items():
            total[lang, g[:-1]] += n
            cut[lang, g[:-1]] += d[min(n, 3) - 1]
        below = {
            (lang, g): (n - d[min(n, 3) - 1]) / total[lang, g[:-1]]
            + cut[lang, g[:-1]] / total[lang, g[:-1]] * (below[lang, g[1:]] if below else 1 / 256)
            for (lang, g), n in level.items()
        }
    return below


def test_counts_and_model_against_brute_force(documents, cases, monkeypatch):
    model = model_of([(r[2], r[1] or "") for r in cases])
    for entries in (1 << 22, 2000):
        monkeypatch.setattr(P, "ARRAY_ENTRIES", entries)
        got = P.score_documents(documents).collect()
        assert len(got) == len(cases)
        want = Counter()
        for doc_id, text, lang, *_ in cases:
            text = text or ""
            raw = bytes(P.ORDER - 1) + text.encode()
            q = sum(math.log(model[lang, raw[i : i + P.ORDER]]) for i in range(len(raw) - P.ORDER + 1))
            want[(doc_id, lang, *base(text), round(q, 1))] += 1
        found = Counter((r["doc_id"], r["lang"], *(r[c] for c in P.COUNTS[:5]), round(r["q"] / P.SCALE, 1)) for r in got)
        near = {k[:-1]: k[-1] for k in found}
        assert Counter({k[:-1]: n for k, n in found.items()}) == Counter({k[:-1]: n for k, n in want.items()})
        assert all(abs(near[k[:-1]] - k[-1]) <= 0.2 for k in want)


def test_probabilities_of_a_context_add_up(documents):
    rows = documents.select(P.language_code(F.col("lang")).alias("code"), F.coalesce("text", F.lit("")).alias("text"))
    counted = P.count_grams(rows).cache()
    sums = P.kneser_ney(counted).groupBy(P._context(F.col("gram"))).agg(F.sum(F.exp(F.col("q") / P.SCALE)).alias("p"))
    assert sums.filter("p > 1.0001").count() == 0


def test_bands_reject_odd_documents_of_a_language(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        lang = "en" if i % 2 else "de"
        stems = ["the", "and", "ing", "ou", "er"] if lang == "en" else ["der", "und", "ung", "sch", "ei"]
        rows.append((i, " ".join("".join(rng.choices(stems, k=rng.randint(1, 4))) for _ in range(120)), lang))
    junk = "".join(chr(rng.randrange(33, 127)) for _ in range(900))
    rows.append((900, " ".join(junk[i : i + 6] for i in range(0, 900, 6)), "en"))
    rows.append((901, "the and " * 200, "en"))
    rows.append((902, "too short", "en"))
    rows.append((903, " ".join("".join(rng.choices(["the", "and"], k=2)) for _ in range(150)), "en"))
    got = {r["doc_id"]: r for r in P.judge_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i]["kept"] for i in range(300))
    assert not any(got[i]["kept"] for i in (900, 901, 902))
    assert got[901]["base_failed"] and got[902]["base_failed"] and not got[900]["base_failed"]
    assert got[900]["perplexity"] > got[900]["upper_band"]
    assert got[903]["perplexity"] < got[903]["lower_band"]


def test_empty_table_and_clashing_columns(nothing, documents):
    assert P.judge_documents(nothing).count() == 0
    clash = documents.withColumns({c: F.lit("x") for c in ("code", "q", "digest", "gram", "low", "high", "kept")})
    assert P.judge_documents(clash).count() == documents.count()


def test_hash_array():
    keys = np.arange(0, 50_000, 7, dtype=np.uint64)
    array = P.HashArray(keys, (keys % np.uint64(1000)).astype(np.int32) + 1)
    found = array.find(np.arange(50_000, dtype=np.uint64))
    assert (found == [(i % 1000 + 1) if i % 7 == 0 else 0 for i in range(50_000)]).all()
    assert (P.HashArray(keys[:0], keys[:0].astype(np.int32)).find(keys) == 0).all()
