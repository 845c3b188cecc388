import random
import re

import pytest
from pyspark.sql import functions as F

from samplyard.operators import search, terms


@pytest.mark.parametrize(
    ("pattern", "want"),
    [
        ("green", ["green"]),
        ("the\\s+of", ["the", "of"]),
        ("colou?r", ["colo", "r"]),
        ("ab+c", ["ab", "c"]),
        ("ab{2,3}cd", ["a", "cd"]),
        ("a[]x]bc", ["a", "bc"]),
        ("one(two)?three", ["one", "three"]),
        ("one(t[)]w)three", ["one", "three"]),
        ("a\\.bcd", ["a", "bcd"]),
        ("red|green", []),
        ("(?:red)x", []),
        ("\\x41bc", []),
        ("^start.*end$", ["start", "end"]),
    ],
)
def test_literal_stretches(pattern, want):
    assert terms.literal_stretches(pattern) == want


def test_every_match_contains_the_stretches():
    rng = random.Random(3)
    matches = 0
    for _ in range(3000):
        pattern = "".join(rng.choice(["a", "b", "ab", "?", "+", "*", "{2}", "[ab]", "(b)", ".", "\\w"]) for _ in range(rng.randrange(1, 6)))
        try:
            regex = re.compile(pattern)
        except re.error:
            continue
        for _ in range(20):
            text = "".join(rng.choice("ab") for _ in range(rng.randrange(6)))
            if hit := regex.search(text):
                matches += 1
                assert all(part in hit[0] for part in terms.literal_stretches(pattern)), (pattern, text)
    assert matches > 1000


def test_gram_finder_sees_overlaps():
    found = re.findall(terms.gram_finder(["abc", "bcd", "b.d", "abx"]), "abcd b.d abc")
    assert found == ["abc", "bcd", "b.d", "abc"]


@pytest.fixture
def cells(frame):
    return frame("k int, a string, b string", [(1, "Green Apple", None), (2, None, None), (3, "", "apple pie"), (4, "grün", "x" * 50_000 + " apple"), (4, "grün", "x" * 50_000 + " apple"), (5, "a.b", "GREEN")])


def test_hits_equal_a_test_of_every_cell(cells):
    wanted = ["apple", "GREEN", "gr.n", "a\\.b", "x{3}", "pie$", "^green", "nothing", "", "app|pie", "apple"]
    got = sorted(tuple(r) for r in terms.term_hits(cells, wanted, ["a", "b", "absent"], ["k"]).collect())
    want = sorted(
        (term, row["k"])
        for term in dict.fromkeys(wanted)
        for row in cells.collect()
        if any(text is not None and re.search(term.lower(), text.lower()) for text in (row["a"], row["b"]))
    )
    assert got == want
    assert terms.term_hits(cells, [], ["a"], ["k"]).count() == 0
    assert terms.term_hits(cells, ["a"], ["absent"], ["k"]).count() == 0
    assert terms.term_hits(cells.limit(0), ["apple"], ["a"], ["k"]).count() == 0
    assert [r["k"] for r in terms.term_hits(cells, ["GREEN", "green"], ["b"], ["k"], exact=True).collect()] == [5]


def test_many_terms_take_one_scan_and_no_shuffle(cells):
    plan = terms.term_hits(cells, [f"word{i}" for i in range(200)], ["a", "b"], ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_limits_rank_narrow_rows(spark, tmp_path):
    spark.range(3000).select("id", F.concat(F.lit("red "), F.col("id") % 7).alias("a"), F.repeat(F.lit("long"), 50).alias("note")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    got = search.row_search(table, ["red", "3$"], ["a"], max_rows=5, order=["id"])
    assert sorted(r["id"] for r in got.collect()) == [0, 1, 2, 3, 4, 10, 17, 24, 31]
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "WindowGroupLimit" in plan and plan.count("FileScan") == 2
    again = search.row_search(table.union(table), ["red"], ["a"], max_rows=4, order=["id"])
    assert sorted(r["id"] for r in again.collect()) == [0, 1]
