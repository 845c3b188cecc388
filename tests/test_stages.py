import itertools
import random
from datetime import timedelta

import pytest
from conftest import at, table
from pyspark.sql import functions as F

from samplyard.streaming import stages, windows
from samplyard.streaming.stages import DAY_MS, Cycle

DDL = "id string, stage string, at timestamp_ntz, outcome string"
START = at("2024-01-01")


def day(n):
    return START + timedelta(days=n)


def run(spark, frame, tmp_path, batches, late="0 days", cycle=Cycle()):
    """Each batch is a file and a micro-batch of its own, in this order: changes, and (state rows, dropped
    rows) after each."""
    for number, rows in enumerate(batches):
        frame(DDL, rows).coalesce(1).write.parquet(f"{tmp_path}/in/{number:02}")
    files = spark.readStream.schema(DDL).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1")
    events = windows.event_time(files.parquet(f"{tmp_path}/in"), "at")
    query = stages.start_stages(events, f"{tmp_path}/out", f"{tmp_path}/log", late, cycle)
    query.awaitTermination()
    states = [p.stateOperators[0] for p in query.recentProgress]
    return spark.read.parquet(f"{tmp_path}/out"), [(s.numRowsTotal, s.numRowsDroppedByWatermark) for s in states]


def expected(events, cycle=Cycle()):
    out = []
    for sample in sorted({e[0] for e in events}):
        first = {s: min((e[2] for e in events if e[:2] == (sample, s)), default=None) for s in cycle.stages}
        ends = [(e[2], e[3]) for e in events if e[0] == sample and e[1] == cycle.stages[-1] and e[3] is not None]
        furthest = [s for s in cycle.stages if first[s] is not None]
        out.append((sample, *first.values(), min(ends)[1] if ends else None, furthest[-1] if furthest else None))
    return out


EVENTS = [
    ("a", "created", day(0), None), ("a", "uploaded", day(1), None), ("a", "submitted", day(2), None), ("a", "finished", day(3), "Succeeded"),
    ("b", "created", day(0), None), ("b", "finished", day(5), "Failed"), ("b", "finished", day(4), "Aborted"), ("b", "finished", day(4), "Succeeded"),
    ("c", "uploaded", day(2), None), ("c", "created", day(1), None), ("c", "created", day(0), None),
    ("d", "finished", day(9), None), ("d", "created", day(2), None),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_events_ends_the_same(spark, frame, tmp_path, seed):
    events = EVENTS * 2
    random.Random(seed).shuffle(events)
    batches = [events[i::3] for i in range(3)]
    changes, _ = run(spark, frame, tmp_path, batches, late="36500 days")
    assert table(stages.current_stages(changes), "id") == expected(EVENTS)
    assert {r.status for r in changes.collect()} == {"open"}


def test_closed_samples_free_their_state(spark, frame, tmp_path):
    cycle = Cycle(grace_ms=DAY_MS, idle_ms=10 * DAY_MS)
    whole = lambda i, n: [(f"s{i}", s, day(n + k * 0.1), "Succeeded" if s == "finished" else None) for k, s in enumerate(cycle.stages)]
    batches = [list(itertools.chain(*(whole(i, 0) for i in range(20))))]
    batches += [[("open", "created", day(3), None)], [("other", "created", day(4), None)]]
    changes, progress = run(spark, frame, tmp_path, batches, cycle=cycle)
    held = [n for n, _ in progress]
    assert held[0] >= 20 and held[-1] <= 4
    rows = changes.groupBy("id").agg(F.collect_set("status").alias("s")).collect()
    assert {r.id: sorted(r.s) for r in rows} == {f"s{i}": ["closed", "open"] for i in range(20)} | {"open": ["open"], "other": ["open"]}
    assert table(stages.current_stages(changes, cycle), "id") == expected([e for b in batches for e in b])


def test_news_moves_the_timer_and_silence_stalls(spark, frame, tmp_path):
    cycle = Cycle(idle_ms=5 * DAY_MS)
    ticks = [[("clock", "tick", day(n), None)] for n in (4, 6, 8, 10, 12)]
    batches = [[("a", "created", day(0), None), ("b", "created", day(0), None)], [("a", "uploaded", day(3), None)], *ticks]
    changes, progress = run(spark, frame, tmp_path, batches, cycle=cycle)
    stalled = {r.id: r.emitted_in for r in changes.filter("status = 'stalled'").collect()}
    assert set(stalled) == {"a", "b"} and stalled["b"] < stalled["a"]
    assert progress[-1][0] <= 2  # the clock alone: its state and its timer


def test_a_sample_that_returns_continues(spark, frame, tmp_path):
    cycle = Cycle(idle_ms=2 * DAY_MS)
    batches = [[("a", "created", day(0), None)], [("x", "created", day(5), None)], [("x", "uploaded", day(6), None)], [("a", "uploaded", day(7), None)]]
    changes, _ = run(spark, frame, tmp_path, batches, cycle=cycle)
    assert changes.filter("id = 'a' AND status = 'stalled'").count() == 1
    assert table(stages.current_stages(changes, cycle), "id") == expected([e for b in batches for e in b])


def test_late_events_are_dropped_and_counted(spark, frame, tmp_path):
    batches = [[("a", "created", day(10), None)], [("a", "created", day(10), None)], [("b", "created", day(1), None), ("c", "created", day(11), None)]]
    changes, progress = run(spark, frame, tmp_path, batches, late="2 days")
    assert {r.id for r in changes.collect()} == {"a", "c"} and sum(n for _, n in progress) == 1


def test_repeated_events_write_nothing_new(spark, frame, tmp_path):
    changes, _ = run(spark, frame, tmp_path, [[EVENTS[0]], [EVENTS[0]], [EVENTS[0]]], late="36500 days")
    assert changes.count() == 1


def test_events_of_rows(frame):
    rows = frame("id string, c timestamp_ntz, f timestamp_ntz, s string", [("a", day(0), day(1), "x"), ("b", None, None, "y"), (None, day(0), None, None), ("c", day(0), None, "z")])
    got = stages.stage_events(rows, {"created": "c", "finished": F.col("f")}, "s")
    assert table(got.select("id", "stage", "outcome")) == [("a", "created", None), ("a", "finished", "x"), ("c", "created", None)]


def test_the_session_is_left_as_it_was(spark):
    with stages.rocksdb_state(spark):
        assert spark.conf.get(stages.PROVIDER) == stages.ROCKSDB
    assert spark.conf.get(stages.PROVIDER, None) != stages.ROCKSDB


def test_samples_of_a_bucket_share_a_call(spark, frame, tmp_path, monkeypatch):
    """All samples in two buckets: states and timers are those of buckets, what they say is that of samples."""
    monkeypatch.setattr(stages, "BUCKETS", 2)
    cycle = Cycle(grace_ms=DAY_MS, idle_ms=4 * DAY_MS)
    rng = random.Random(3)
    events = [(f"s{i}", s, day(rng.random()), f"o{i % 3}" if s == "finished" else None) for i in range(200) for s in rng.sample(cycle.stages, 1 + i % 4)]
    events += [(None, "created", day(0), None)]
    rng.shuffle(events)
    batches = [events[::2], events[1::2], [("s1", "tick", day(4), None)], [("s2", "tick", day(9), None)], [("s2", "tick", day(10), None)]]
    changes, progress = run(spark, frame, tmp_path, batches, late="2 days", cycle=cycle)
    assert progress[1][0] <= 4 and max(n for _, n in progress) == 0
    named = [e for e in events if e[0] is not None]
    assert table(stages.current_stages(changes, cycle).filter("id IS NOT NULL"), "id") == expected(named, cycle)
    over = {r.id: r.status for r in changes.filter("status <> 'open'").collect()}
    ended = {e[0] for e in named if e[1] == "finished"}
    # s1 had news, s2 has them still; both wait longer than the others unless they ended.
    assert all(over[i] == "closed" for i in ended - {"s2"}) and all(over[i] == "stalled" for i in {e[0] for e in events} - ended - {"s1", "s2"})
