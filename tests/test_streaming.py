import pytest
from conftest import at, table, values
from pyspark.sql import functions as F

from samplyard.plans.ingest import process_samples
from samplyard.schema import SchemaSpec
from samplyard.streaming import ingest, windows

SCHEMA = SchemaSpec.from_yaml("""
fields:
  id: {type: string, primary_key: true}
  sample_id: {type: string, sample_identifier: true}
  read1: {type: string, sequence_file: true}
  created_at: {type: datetime, system_value: true}
""")
DDL = "sample_id string, read1 string"
NOW = "2024-01-01 00:00:00"


def land(frame, folder, name, rows, ddl=DDL):
    frame(ddl, rows).coalesce(1).write.mode("append").parquet(str(folder / name))


def test_streamed_ingest_equals_batch(spark, frame, tmp_path):
    landing, out, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    batches = [[("a", "f"), ("b", ""), ("a", "f2")], [("a", "f"), ("c", "f")], [("c", "f"), ("d", "f"), (None, "f")]]
    for number, rows in enumerate(batches):
        land(frame, landing, f"part{number}", rows)
        stream = spark.readStream.schema(DDL).option("recursiveFileLookup", "true").parquet(str(landing))
        ingest.start_ingest(stream, SCHEMA, out, log, as_of=NOW).awaitTermination()
    streamed = ingest.read_table(spark, out, SCHEMA)
    assert values(streamed, "sample_id") == [None, "a", "c", "d"]
    everything = spark.read.schema(DDL).option("recursiveFileLookup", "true").parquet(str(landing))
    batch = process_samples(everything, SCHEMA, dedupe_within_batch=True, as_of=NOW)
    assert values(batch, "sample_id") == values(streamed, "sample_id")
    assert values(ingest.read_table(spark, out, SCHEMA, 1), "sample_id") == ["a"]


def test_a_repeated_batch_replaces_itself(spark, frame, tmp_path):
    out = str(tmp_path / "out")
    for log in ("log1", "log2"):  # a fresh log makes the stream run its batch 0 again
        land(frame, tmp_path / "in", log, [("a", "f")])
        stream = spark.readStream.schema(DDL).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        ingest.start_ingest(stream, SCHEMA, out, str(tmp_path / log), as_of=NOW).awaitTermination()
    assert values(ingest.read_table(spark, out, SCHEMA), "sample_id") == ["a"]


EVENTS = [("x", at(f"2024-01-01T{h:02}:{m:02}:00")) for h in range(6) for m in (0, 20, 59)] + [("y", at("2024-01-01T01:30:00"))]


@pytest.mark.parametrize("build, slide", [(windows.hourly_counts, None), (windows.sliding_counts, "1 hour")])
def test_windows_equal_batch(spark, frame, tmp_path, build, slide):
    ddl = "kind string, ts timestamp_ntz"
    for number in range(3):
        land(frame, tmp_path / "in", f"p{number}", EVENTS[number::3], ddl)
    stream = spark.readStream.schema(ddl).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    counts = build(windows.event_time(stream, "ts"), "ts", ["kind"], "1 day")
    windows.start_updates(counts, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    got = windows.latest_state(spark.read.parquet(str(tmp_path / "out")), ["window_start", "window_end", "kind"])
    wanted = windows.windowed_counts(frame(ddl, EVENTS), "ts", ["kind"], "4 hours" if slide else "1 hour", slide)
    plain = lambda df: table(df.select(F.col("window_start").cast("timestamp_ntz"), F.col("window_end").cast("timestamp_ntz"), "kind", "events"))
    assert plain(got) == plain(wanted)


def test_repeats_inside_the_watermark_are_dropped(spark, frame, tmp_path):
    ddl = "sid string, ts timestamp_ntz"
    land(frame, tmp_path / "in", "p", [("a", at("2024-01-01")), ("a", at("2024-01-01T01:00")), ("b", at("2024-01-01"))], ddl)
    stream = spark.readStream.schema(ddl).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    query = (
        windows.without_repeats(windows.event_time(stream, "ts"), "ts", "sid", "1 day")
        .writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert values(spark.read.parquet(str(tmp_path / "out")), "sid") == ["a", "b"]


def test_life_cycle(spark, frame, tmp_path):
    ddl = "id string, created_at timestamp_ntz, uploaded_at timestamp_ntz, submitted_at timestamp_ntz"
    day = at("2024-01-01")
    land(frame, tmp_path / "in", "p1", [("a", day, None, None), ("b", day, None, None)], ddl)
    land(frame, tmp_path / "in", "p2", [("a", day, day, None), ("c", day, day, day)], ddl)
    stream = spark.readStream.schema(ddl).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    windows.start_updates(windows.lifecycle(stream), str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    got = windows.latest_state(spark.read.parquet(str(tmp_path / "out")), ["id"])
    assert table(got.select("id", "stage")) == [("a", "uploaded"), ("b", "created"), ("c", "submitted")]


def test_rows_later_than_the_bound_are_counted(spark, frame, tmp_path):
    ddl = "kind string, ts timestamp_ntz"
    for number, hour in enumerate((20, 1, 22, 2)):
        land(frame, tmp_path / "in", f"p{number}", [("x", at(f"2024-01-01T{hour:02}:00:00"))], ddl)
        stream = spark.readStream.schema(ddl).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        counts = windows.hourly_counts(windows.event_time(stream, "ts"), "ts", ["kind"], "1 hour")
        query = windows.start_updates(counts, str(tmp_path / "out"), str(tmp_path / "log"))
        query.awaitTermination()
        assert windows.dropped_rows(query) == (1 if number in (1, 3) else 0)


def test_streamed_ingest_knows_rows_loaded_otherwise(spark, frame, tmp_path):
    loaded = frame("sample_id string, other string", [("a", "x"), (None, "y")])
    for number, rows in enumerate([[("a", "f"), ("b", "f")], [("a", "f"), ("c", "f"), ("b", "f")]]):
        land(frame, tmp_path / "in", f"p{number}", rows)
        stream = spark.readStream.schema(DDL).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        ingest.start_ingest(stream, SCHEMA, str(tmp_path / "out"), str(tmp_path / "log"), known=lambda: loaded, as_of=NOW).awaitTermination()
    assert values(ingest.read_table(spark, str(tmp_path / "out"), SCHEMA), "sample_id") == ["b", "c"]
