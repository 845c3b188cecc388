import json
import random

import pytest
from conftest import table

from samplyard.sources import pages as p

ITEM = "struct<Key:bigint>"
DDL = "name string, value string"


def page(start, keys, total, displayed=None):
    count = len(keys) if displayed is None else displayed
    return json.dumps({"Items": [{"Key": k} for k in keys], "Paging": {"Offset": start, "Limit": 10, "DisplayedCount": count, "TotalCount": total}})


def span_page(start, stop, total):
    return page(start, list(range(start, stop)), total)


def report(frame, rows, slice_size=p.SLICE):
    spans = p.page_spans(frame(DDL, rows), ["name"], ITEM)
    found = {r["name"]: tuple(r)[1:] for r in p.completeness(spans, ["name"], slice_size).collect()}
    return found, table(p.missing_ranges(spans, ["name"], slice_size))


def test_each_status(frame):
    rows = [
        ("whole", span_page(0, 3, 5)), ("whole", span_page(3, 5, 5)),
        ("twice", span_page(0, 5, 5)), ("twice", span_page(0, 5, 5)), ("twice", span_page(0, 5, 5)),
        ("over", span_page(0, 4, 6)), ("over", span_page(2, 6, 6)),
        ("holes", span_page(2, 3, 9)), ("holes", span_page(5, 7, 9)),
        ("grown", span_page(0, 2, 2)), ("grown", span_page(2, 3, 3)),
        ("short", page(0, [1, 2], 3, displayed=3)), ("none", page(0, [], 0)),
        ("bad", span_page(0, 2, 2)), ("bad", "{"), (None, span_page(1, 2, 2)),
    ]
    found, ranges = report(frame, rows)
    assert found == {  # pages, repeated, total, overlapping, gaps, missing, status
        "whole": (2, 0, 5, 0, 0, 0, "complete"), "twice": (3, 2, 5, 0, 0, 0, "complete"), "over": (2, 0, 6, 2, 0, 0, "overlapping"),
        "holes": (2, 0, 9, 0, 3, 6, "incomplete"), "grown": (2, 0, 3, 0, 0, 0, "total_changed"), "short": (1, 0, 3, 0, 1, 1, "miscounted"),
        "none": (1, 0, 0, 0, 0, 0, "complete"), "bad": (2, 0, 2, 0, 0, 0, "unreadable"), None: (1, 0, 2, 0, 1, 1, "incomplete"),
    }
    holes = [("holes", 0, 2), ("holes", 3, 5), ("holes", 7, 9), (None, 0, 1), ("short", 2, 3)]
    assert sorted(ranges, key=str) == sorted(holes, key=str)


@pytest.mark.parametrize("slice_size", [1, 7, 50, p.SLICE])
def test_any_slice_size_finds_the_same(frame, slice_size):
    rng = random.Random(5)
    rows, covered, total = [], {}, {}
    for name in "abcd":
        total[name] = rng.randrange(60, 150)
        for _ in range(12):
            start = rng.randrange(total[name])
            stop = min(total[name], start + rng.randrange(1, 25))
            rows.append((name, span_page(start, stop, total[name])))
            covered.setdefault(name, set()).update(range(start, stop))
    found, ranges = report(frame, rows, slice_size)
    for name in "abcd":
        holes = set(range(total[name])) - covered[name]
        assert found[name][5] == len(holes)
        assert found[name][4] == len([h for h in holes if h - 1 not in holes])
        mine = [set(range(a, b)) for n, a, b in ranges if n == name]
        assert set().union(*mine) == holes and sum(map(len, mine)) == len(holes)
        distinct = {v for n, v in rows if n == name}
        assert found[name][3] == sum(len(json.loads(v)["Items"]) for v in distinct) - len(covered[name])


def test_items_are_taken_once(frame):
    rows = [("a", page(0, [10, 11, 12], 5)), ("a", page(0, [10, 11, 12], 5)), ("a", page(2, [99, 13, 14], 5)), ("b", page(0, [1], 1)), ("c", "{")]
    found = p.positioned_items(frame(DDL, rows), ["name"], ITEM)
    got = sorted((r["name"], r["position"], r["item"]["Key"]) for r in found.collect())
    assert got == [("a", 0, 10), ("a", 1, 11), ("a", 2, 12), ("a", 3, 13), ("a", 4, 14), ("b", 0, 1)]


def test_no_pages(frame):
    assert report(frame, []) == ({}, [])
