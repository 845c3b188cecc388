"""The pipeline's stages against brute force, each on what its predecessor kept."""

import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from samplyard.llm import quality
from tests.llm.test_paritysketch import brute as brute_groups
from tests.llm.test_paritysketch import brute_of, edited_texts
from tests.llm.test_replication import poisson, unit
from tests.llm.test_substrings import brute as brute_cuts

COLUMNS = list(corpus_pipeline.COLUMNS)


@pytest.fixture(scope="module")
def folder(spark, documents, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    documents.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).write.parquet(f"{path}/documents.parquet")
    labels = documents.filter("doc_id IS NOT NULL").select("doc_id", F.when(F.length("text") > 40, 1).otherwise(0).alias("quality"), F.lit(0).alias("toxic"))
    labels.write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def staged(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stages"))
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    out.append(docs)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{path}/{i}")
        docs = spark.read.parquet(f"{path}/{i}")
        out.append(docs)
    return out


def rows(df):
    return [tuple(r) for r in df.select(COLUMNS).collect()]


def test_stages_keep_the_columns(staged):
    assert all(df.columns == COLUMNS for df in staged[:-1])


def test_quality_stage(spark, folder, staged):
    scored = quality.score_documents(staged[0], spark.read.parquet(f"{folder}/labels.parquet"))
    want = {r["doc_id"] for r in scored.collect() if r["score"] >= quality.THRESHOLD}
    assert {r[0] for r in rows(staged[1])} == want
    assert 0 < len(want) < staged[0].count()


def test_near_copy_stage(staged):
    before = rows(staged[1])
    least = {k[0] for k in brute_of(before, 5, 80) if k[0] == k[2]}
    assert Counter(rows(staged[2])) == Counter(r for r in before if r[0] in least)
    assert len(least) < len(before)


def test_substring_stage(staged):
    before = rows(staged[2])
    cuts = {k[0]: k for k in brute_cuts(before, 13)}
    want = {d for d, n, gone, _ in cuts.values() if gone == 0 or gone < n}
    after = rows(staged[3])
    assert {r[0] for r in after} == want
    texts = {r[0]: r for r in before}
    for r in after:
        if cuts[r[0]][2] == 0:
            assert r == (r[0], texts[r[0]][1] or "", *texts[r[0]][2:])
        else:
            assert len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) == cuts[r[0]][1] - cuts[r[0]][2] and r[4] == len(r[1])


def test_mixing_stage(staged):
    before = rows(staged[3])
    n = Counter(r[3] for r in before)
    want = Counter()
    for r in before:
        want[r] += poisson(unit(f"17:{r[0]}"), 1 / len(n) * len(before) / n[r[3]])
    assert Counter(rows(staged[4])) == +want


def test_packing_stage(staged):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sum(len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows(staged[4]))
    assert staged[5].agg(F.sum("length")).first()[0] == want


def test_run_equals_the_stages(spark, folder, staged):
    got = corpus_pipeline.run(spark, folder)
    assert got.agg(F.sum("length")).first()[0] == staged[5].agg(F.sum("length")).first()[0]
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_tables(spark, nothing, tmp_path):
    nothing.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_are_of_five_words_and_80_percent(spark, folder):
    words = [f"w{i}" for i in range(500)]
    edited = [f"e{i}" if i % 50 == 25 else w for i, w in enumerate(words)]
    rows = [(d, text, "en", "s", len(text)) for d, text in [*edited_texts(), (1000, " ".join(words)), (1001, " ".join(edited))]]
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), folder)
    least = {k[0] for k in brute_of(rows, 5, 80) if k[0] == k[2]}
    assert 1000 in least and 1001 not in least
    assert {r["doc_id"] for r in kept.collect()} == least
    assert least != {k[0] for k in brute_groups(rows) if k[0] == k[2]}


def test_rows_without_and_with_repeated_doc_ids(spark, folder):
    """Null doc_ids are no value to be one by; texts under one doc_id are not copies of each other."""
    text = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcdef"]
    given = [
        (None, text[0], "en", "s", 1), (None, text[1], "en", "s", 1), (None, None, "en", "s", 1), (None, text[2], "de", "t", 2),
        (None, text[2], "de", "s", 3), (7, text[3], "en", "s", 1), (7, text[4], "en", "s", 1), (7, text[4], None, "s", 1), (9, text[5], "en", "s", 1),
    ]
    df = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long")
    want = sorted(map(str, [*given[:3], given[4], given[5], given[7], given[8]]))
    for n in (1, 5):
        kept = corpus_pipeline.drop_near_copies(spark, df.repartition(n), folder)
        assert sorted(map(str, rows(kept))) == want


def test_stages_with_null_and_repeated_doc_ids(spark, documents, folder, tmp_path):
    """The fixture as it is: no clean text is lost on the way to the packing."""
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    docs, steps = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        steps.append(docs)
    before, after = rows(steps[0]), rows(steps[1])
    least = {k[0] for k in brute_of(before, 5, 80) if k[0] == k[2]}
    assert any(r[0] is None for r in before)
    want = {}
    for r in before:
        if r[0] is None or r[0] in least:
            want[r[:2]] = min([want.get(r[:2], r), r], key=lambda x: [(v is not None, v) for v in x[2:]])
    assert Counter(after) == Counter(want.values())
    cut, mixed = rows(steps[2]), rows(steps[3])
    assert sum(r[0] is None for r in cut) == sum(r[0] is None for r in after)
    n, counts = Counter(r[3] for r in cut), Counter()
    for r in cut:
        counts[r] += poisson(unit(f"17:{'null' if r[0] is None else r[0]}"), 1 / len(n) * len(cut) / n[r[3]])
    assert Counter(mixed) == +counts
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = sum(len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in mixed)
    assert steps[4].agg(F.sum("length")).first()[0] == tokens
