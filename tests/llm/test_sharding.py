import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from samplyard.llm.sharding import shard_documents


def greedy(sizes, capacity):
    count, fill = 1, 0
    for s in sizes:
        if fill + s > capacity:
            count, fill = count + 1, 0
        fill += s
    return count


def check(rows, got, shards):
    assert len(got) == len(rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows
    )
    slots, atoms, fill = defaultdict(list), {}, Counter()
    sizes = Counter()
    for r in got:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        assert atoms.setdefault(r["atom"], r["shard"]) == r["shard"]
        fill[r["shard"]] += r["size"]
        sizes[r["atom"]] += r["size"]
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    # Atoms above the fair share are alone; the others have the least feasible capacity.
    left, alone = dict(sizes), 0
    while alone < shards - 1 and left and max(left.values()) * (shards - alone) > sum(left.values()):
        big = min(left, key=lambda a: (-left[a], a))
        assert fill[atoms[big]] == left.pop(big)
        alone += 1
    if left:
        ordered = [left[a] for a in sorted(left)]
        low = max(max(ordered), -(-sum(ordered) // (shards - alone)))
        while greedy(ordered, low) > shards - alone:
            low += 1
        assert max(fill[atoms[a]] for a in left) <= low
        in_order = [atoms[a] for a in sorted(left)]
        assert in_order == sorted(in_order)


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_against_brute_force(documents, cases, shards):
    check(cases, shard_documents(documents, shards).collect(), shards)


def test_a_hot_text_is_split_over_slices_but_not_over_shards(spark):
    rows = [(i, "hot " * 20 if i % 3 else f"text {i} " * (i % 7), None, None, None) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = shard_documents(df, 24).collect()
    check(rows, got, 24)
    assert len({r["shard"] for r in got}) == 24


def test_empty_and_clashing_columns(nothing, documents):
    assert shard_documents(nothing).count() == 0
    clash = documents.withColumns({c: F.lit("x") for c in ("shard", "slot", "size", "atom", "before", "place")})
    assert shard_documents(clash, 4).count() == documents.count()


def test_no_python_in_the_plan(documents):
    plan = shard_documents(documents)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
