import pytest
from conftest import values
from pyspark.sql import functions as F

from samplyard.schema import SchemaSpec
from samplyard.session import list_folders
from samplyard.streaming import ingest
from samplyard.streaming.known import IdentifierIndex, bucket_of

KEYS = ["sid", "cfg"]


def ids(spark, start, stop, step=1):
    return spark.range(start, stop, step, 2).select(F.concat(F.lit("s"), "id").alias("sid"), F.lit("c").alias("cfg"))


def read_bytes(scans):
    """Bytes of the files that the scans open."""
    files = [s.select("_metadata.file_path", "_metadata.file_size").distinct() for s in scans]
    return sum(r.file_size for f in files for r in f.collect())


def test_reads_do_not_grow_with_what_is_loaded(spark, tmp_path):
    """Batches of twenty identifiers into an index of eight a bucket."""
    index, opened, runs = IdentifierIndex(spark, str(tmp_path / "known"), KEYS, per_bucket=8, fan=4), [], []
    index.add(ids(spark, 0, 200), -1)
    for number in range(20):
        index.fold(number)
        batch = ids(spark, 1000 + 16 * number, 1016 + 16 * number).unionByName(ids(spark, 10 * number, 10 * number + 4))
        scans = index.scans(batch, number)
        opened.append(read_bytes(scans))
        runs.append(len(scans))
        if number % 6 == 5:
            seen = index.known(batch, number).join(batch.select("sid"), "sid", "left_semi")
            assert seen.count() == 4  # those of the first load, and none else
        index.add(batch.filter(F.substring("sid", 2, 9).cast("int") >= 1000), number)
    assert max(runs) <= 9
    assert max(opened[10:]) <= 1.5 * max(opened[:10])
    whole = sum(f.stat().st_size for f in (tmp_path / "known").rglob("*.parquet"))
    assert opened[-1] < 0.6 * whole
    everything = index.known(ids(spark, 0, 3000), 99)
    assert values(everything.select("sid").distinct()) == values(ids(spark, 0, 200).unionByName(ids(spark, 1000, 1320)).select("sid"))


def test_a_repeated_batch_sees_what_it_saw(spark, tmp_path):
    index = IdentifierIndex(spark, str(tmp_path / "known"), KEYS, per_bucket=2, fan=2)
    assert index.known(ids(spark, 0, 4), 0) is None
    for number in range(3):
        index.fold(number)
        index.add(ids(spark, 3 * number, 3 * number + 3), number)
    index.add(ids(spark, 50, 90), 3)  # left by an attempt that failed: more buckets, another name
    index.forget_from(3)
    index.add(ids(spark, 50, 51), 3)
    assert [r.batch for r in index.runs()].count(3) == 1
    assert values(index.known(ids(spark, 0, 60), 3).select("sid")) == [f"s{i}" for i in range(9)]
    assert values(index.known(ids(spark, 0, 60), 2).select("sid")) == [f"s{i}" for i in range(6)]


def test_rows_without_identifier_and_unfinished_runs_do_not_count(spark, frame, tmp_path):
    index = IdentifierIndex(spark, str(tmp_path / "known"), KEYS)
    index.add(frame("sid string, cfg string", [(None, "c")]), 0)
    assert index.runs() == []
    index.add(frame("sid string, cfg string", [("a", None), ("a", None), (None, "c")]), 1)
    assert [tuple(r) for r in index.known(ids(spark, 0, 1), 2).collect()] == [("a", None)]
    ids(spark, 0, 5).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{index.path}/run_0_2_1")
    (tmp_path / "known" / "run_0_2_1" / "_SUCCESS").unlink()
    assert [r.batch for r in index.runs()] == [1]


def test_buckets_of_fewer_are_rests(spark):
    rows = ids(spark, 0, 50).select(bucket_of("sid", 64).alias("a"), bucket_of("sid", 8).alias("b")).collect()
    assert all(r.a % 8 == r.b for r in rows)


SCHEMA = SchemaSpec.from_yaml("""
fields:
  id: {type: string, primary_key: true}
  sample_id: {type: string, sample_identifier: true}
  read1: {type: string, sequence_file: true}
""")


def test_stream_with_folds_and_seed(spark, frame, tmp_path):
    ddl, out = "sample_id string, read1 string", str(tmp_path / "out")
    for number in range(7):
        rows = [(f"s{i}", "f") for i in range(3 * number, 3 * number + 5)] + [("seeded", "f"), (None, "f")]
        frame(ddl, rows).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{number}"))
    stream = spark.readStream.schema(ddl).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    seeded = []

    def seed():
        seeded.append(1)
        return frame("sample_id string, other int", [("seeded", 1), (None, 2)])

    ingest.start_ingest(stream, SCHEMA, out, str(tmp_path / "log"), seed=seed, per_bucket=2, fan=3).awaitTermination()
    got = values(ingest.read_table(spark, out, SCHEMA), "sample_id")
    assert got == sorted([None] * 7 + [f"s{i}" for i in range(23)], key=str)
    assert len(seeded) == 1
    assert len(list_folders(spark, f"{out}/_known")) < 8
    assert list_folders(spark, str(tmp_path / "missing")) == []
