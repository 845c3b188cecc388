"""Life cycles as a keyed state machine over events of samples.

An event says that a sample reached a stage at a time. The state of a sample is the first time of each
stage; whatever order events arrive in, and however often, it ends the same. A sample that reached the
last stage is closed when the watermark has passed its grace, one without news for long is stalled;
either way its state is freed, so the store holds live samples only.

Samples are kept in buckets, one state and one timer each, so that a call into Python and the state store
serves many samples.

Every change is written once, as a row that holds all that is known. :func:`current_stages` adds such rows up:
a sample that shows up again after its state was freed continues where it was.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from samplyard.functions.columns import col
from samplyard.functions.dates import utc_instant
from samplyard.streaming.windows import start_updates

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 24 * 3600 * 1000
OPEN, CLOSED, STALLED = "open", "closed", "stalled"
#: Samples are kept together by a hash of their id. A checkpoint goes with this number.
BUCKETS = 4096
#: Stands for a time that is not known.
MISSING = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Cycle:
    """Stages in order, and how long the state of a sample is kept, in event time.

    ``grace_ms``: after the last stage; ``idle_ms``: after the newest event of a sample that is not
    there yet.
    """

    stages: tuple[str, ...] = ("created", "uploaded", "submitted", "finished")
    grace_ms: int = 2 * DAY_MS
    idle_ms: int = 90 * DAY_MS

    @property
    def times(self) -> list[str]:
        return [f"{s}_at" for s in self.stages]

    @property
    def output(self) -> str:
        return ", ".join(["id string", *[f"{t} long" for t in self.times], "outcome string", "status string"])


def stage_events(samples: DataFrame, times: Mapping[str, str | Column], outcome: str | Column | None = None, key: str = "id") -> DataFrame:
    """``id, stage, at, outcome``: one row for each stage that a row of samples has a time of.

    ``times`` gives the column of each stage in order, ``outcome`` how the last one ended. Rows without
    an id tell nothing about a sample and drop out.
    """
    as_column = lambda c: col(c) if isinstance(c, str) else c
    *_, last = times
    ended = F.lit(None) if outcome is None else as_column(outcome)
    events = [
        F.struct(
            F.lit(stage).alias("stage"),
            utc_instant(as_column(time)).alias("at"),
            (ended if stage == last else F.lit(None)).cast("string").alias("outcome"),
        )
        for stage, time in times.items()
    ]
    rows = samples.filter(col(key).isNotNull()).select(col(key).cast("string").alias("id"), F.inline(F.array(*events)))
    return rows.filter("at IS NOT NULL")


@dataclass(frozen=True)
class Known:
    """What is known of samples: a column each; ``times`` has a row for each stage, ``MISSING`` where there is none."""

    ids: pa.Array
    times: np.ndarray
    outcome: np.ndarray
    newest: np.ndarray

    def of(self, chosen: np.ndarray) -> Known:
        return Known(self.ids.filter(pa.array(chosen)), self.times[:, chosen], self.outcome[chosen], self.newest[chosen])


class LifeCycles(StatefulProcessor):
    """State of the samples of one bucket, in columns: micros of each stage, outcome and newest event of each, and
    the one timer that is set, for the first sample that is due.

    What a call costs is shared by the samples of the bucket.
    """

    def __init__(self, cycle: Cycle):
        self.cycle = cycle

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("lives", "samples binary, timer long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        news = pd.concat(rows, ignore_index=True)
        held, timer = self._held()
        n, last = len(held.ids), len(self.cycle.stages) - 1
        names = pa.concat_arrays([held.ids, pa.array(news["id"], pa.string(), from_pandas=True)])
        coded = names.dictionary_encode("encode")  # the held ones come first, in their order
        more = len(coded.dictionary) - n
        sample = coded.indices.to_numpy()[n:]
        place = {s: i for i, s in enumerate(self.cycle.stages)}
        stage = news["stage"].map(place).fillna(-1).to_numpy(np.int64)
        micros = news["micros"].to_numpy(np.int64)

        known = Known(
            coded.dictionary,
            np.concatenate([held.times, np.full((last + 1, more), MISSING)], axis=1),
            np.concatenate([held.outcome, np.full(more, None)]),
            np.concatenate([held.newest, np.full(more, -MISSING)]),
        )
        before = known.times.copy(), known.outcome.copy()
        np.maximum.at(known.newest, sample, micros)
        ended = np.flatnonzero((stage == last) & news["outcome"].notna().to_numpy())
        # The first end counts; of ends at the same moment, the lesser text.
        for of, at, text in sorted(zip(sample[ended].tolist(), micros[ended].tolist(), news["outcome"].to_numpy()[ended])):
            end, there = known.times[last, of], known.outcome[of]
            if end == MISSING or there is None or (at, text) < (end, there):
                known.outcome[of] = text
            known.times[last, of] = min(end, at)
        np.minimum.at(known.times, (stage[stage >= 0], sample[stage >= 0]), micros[stage >= 0])
        self._keep(known, timer)
        changed = (known.times != before[0]).any(axis=0) | (known.outcome != before[1])
        if changed.any():
            yield self._rows(known.of(changed), OPEN)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known, _ = self._held()
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        over = self._due(known) <= now  # there may have been news since the timer was set
        self._keep(known.of(~over), None)
        ended = known.times[-1] != MISSING
        for status, which in ((CLOSED, over & ended), (STALLED, over & ~ended)):
            if which.any():
                yield self._rows(known.of(which), status)

    def close(self) -> None:
        pass

    def _due(self, known: Known) -> np.ndarray:
        end = known.times[-1]
        return np.where(end == MISSING, known.newest // 1000 + self.cycle.idle_ms, end // 1000 + self.cycle.grace_ms)

    def _held(self) -> tuple[Known, int | None]:
        held = self.state.get()
        if held is None:
            return Known(pa.array([], pa.string()), np.zeros((len(self.cycle.stages), 0), np.int64), np.zeros(0, object), np.zeros(0, np.int64)), None
        with pa.ipc.open_stream(held[0]) as stream:
            ids, *times, outcome, newest = stream.read_next_batch().columns
        return Known(ids, np.stack([t.to_numpy() for t in times]), outcome.to_numpy(zero_copy_only=False), newest.to_numpy()), held[1]

    def _keep(self, known: Known, timer: int | None) -> None:
        """One timer a bucket. A later moment waits until the set one fires, an earlier one replaces it."""
        if not len(known.ids):
            self.state.clear()
            return
        due = int(self._due(known).min())
        if timer is None or timer > due:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
            timer = due
        columns = [known.ids, *[pa.array(t) for t in known.times], pa.array(known.outcome, pa.string()), pa.array(known.newest)]
        batch = pa.RecordBatch.from_arrays(columns, ["id", *self.cycle.times, "outcome", "newest"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_batch(batch)
        self.state.update((sink.getvalue().to_pybytes(), timer))

    def _rows(self, known: Known, status: str) -> pd.DataFrame:
        columns = {t: pd.arrays.IntegerArray(v, v == MISSING) for t, v in zip(self.cycle.times, known.times)}
        return pd.DataFrame({"id": known.ids.to_numpy(zero_copy_only=False), **columns, "outcome": known.outcome, "status": status})


def track_stages(events: DataFrame, late: str, cycle: Cycle = Cycle()) -> DataFrame:
    """Stream of changes: ``id``, a time per stage, ``outcome`` and ``status``.

    ``events`` is a stream of ``id, stage, at, outcome``. A status is ``open``, or, as the state is freed,
    ``closed`` or ``stalled``. Events later than ``late`` behind the newest one are dropped and counted
    (:func:`~samplyard.streaming.windows.dropped_rows`), unknown stages only count as news. An end
    may have no outcome; the first end with one decides.
    """
    bucket = F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).alias("bucket")
    stamped = events.withWatermark("at", late).select(bucket, "id", "stage", "at", "outcome", F.unix_micros("at").alias("micros"))
    tracked = stamped.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=LifeCycles(cycle), outputStructType=cycle.output, outputMode="Update", timeMode="EventTime"
    )
    times = [F.timestamp_micros(t).cast("timestamp_ntz").alias(t) for t in cycle.times]
    return tracked.select("id", *times, "outcome", "status")


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, on disk; the session is left as it was."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def start_stages(
    events: DataFrame, path: str, checkpoint: str, late: str = "7 days", cycle: Cycle = Cycle(), available_now: bool = True
) -> StreamingQuery:
    """Track a stream of events and write the changes of every micro-batch (safe to repeat)."""
    with rocksdb_state(events.sparkSession):
        return start_updates(track_stages(events, late, cycle), path, checkpoint, available_now)


def current_stages(changes: DataFrame, cycle: Cycle = Cycle()) -> DataFrame:
    """One row per sample from its changes: the first time of each stage, ``outcome`` and the furthest
    ``stage``. The order of the changes does not matter, and repeated ones change nothing."""
    last = cycle.times[-1]
    firsts = changes.groupBy("id").agg(
        *[F.min(t).alias(t) for t in cycle.times],
        F.min(F.when(col("outcome").isNotNull(), F.struct(last, "outcome")))["outcome"].alias("outcome"),
    )
    furthest = F.coalesce(*[F.when(col(t).isNotNull(), F.lit(s)) for s, t in reversed(list(zip(cycle.stages, cycle.times)))])
    return firsts.withColumn("stage", furthest)
