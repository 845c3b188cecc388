import re
import uuid

import pytest
from conftest import at, table
from pyspark.sql import functions as F

from samplyard.operators import update
from samplyard.schema import SchemaSpec
from samplyard.sources import bucketed, store

SCHEMA = SchemaSpec.from_yaml("""
fields:
  id: {type: string, required: true, primary_key: true}
  sample_id: {type: string, sample_identifier: true}
  created_at: {type: datetime}
  updated_at: {type: datetime}
  uploaded_at: {type: datetime}
  submitted_at: {type: datetime}
  upload_source: {type: string}
  submission_id: {type: string}
  workflow_id: {type: string}
  workflow_state: {type: string}
  total: {type: float}
""")
NOW = "2024-06-01 00:00:00"


def rows(spark, n=60):
    day = F.when(F.col("n") % 7 != 6, F.expr("timestamp_ntz '2024-01-01 10:00:00' + make_dt_interval(cast(n % 7 AS int))"))
    numbered = spark.range(n).withColumnRenamed("id", "n").select(F.concat(F.lit("i"), "n").alias("id"), day.alias("created_at"), "n")
    full = numbered.withColumns({"sample_id": F.concat(F.lit("s"), "n"), "total": F.col("n").cast("double")})
    return store.conform(full, SCHEMA)


@pytest.fixture
def stored(spark, tmp_path):
    name = f"samples_{uuid.uuid4().hex}"
    assert bucketed.create_bucketed(spark, name, SCHEMA, 8, str(tmp_path / "samples"))
    bucketed.append_bucketed(rows(spark), name)
    yield name
    spark.sql(f"DROP TABLE {name}")


def files(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_append_fills_every_bucket_once_a_day(spark, stored, tmp_path):
    assert bucketed.bucket_count(spark, stored) == 8
    assert table(spark.table(stored).select(*SCHEMA.names), "id") == table(rows(spark), "id")
    names = [(p.parent.name, re.search(r"_(\d{5})", p.name.removeprefix("part-")).group(1)) for p in files(tmp_path / "samples")]
    assert len(names) == len(set(names)) and len({d for d, _ in names}) == 7


@pytest.mark.parametrize("partitions, limit", [("4", "-1"), ("64", "-1"), ("8", "10m")])
def test_joins_leave_the_table_where_it_is(spark, stored, partitions, limit):
    settled = bucketed.dealt(bucketed.settled_values(rows(spark).filter("total < 30"), {"upload_source": F.lit("x")}), 8)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        plan = bucketed.changed_rows(spark.table(stored), settled, SCHEMA, NOW)._jdf.queryExecution().sparkPlan().toString()
        executed = bucketed.changed_rows(spark.table(stored), settled, SCHEMA, NOW)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "FileScan parquet" in plan
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    lines = executed.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "samples" in line)
    above, level = [], depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    assert any("Join" in line for line in above) and not any("Exchange" in line for line in above)


def test_update_equals_the_plain_one_and_rewrites_few_days(spark, frame, stored, tmp_path):
    before = files(tmp_path / "samples")
    updates = frame("id string, position long, changes map<string,string>", [
        ("i0", 0, {"upload_source": "a", "total": "7.5"}), ("i7", 1, {"upload_source": "b"}), ("i7", 2, {"upload_source": "c"}),
        ("i6", 3, {"workflow_state": "Running"}), ("none", 4, {"upload_source": "d"}), ("i1", 5, {}), (None, 6, {"upload_source": "e"}),
    ])
    counts = bucketed.update_bucketed(spark, stored, updates, SCHEMA, NOW)
    wanted = update.apply_records(rows(spark), updates, SCHEMA, NOW)
    assert table(spark.table(stored).select(*SCHEMA.names), "id") == table(wanted, "id")
    assert [tuple(r) for r in counts.collect()] == [(0, 4, 1, 2)]
    after = files(tmp_path / "samples")
    gone = {p.parent.name for p in set(before) - set(after)}
    assert gone == {"created_date=2024-01-01", "created_date=__HIVE_DEFAULT_PARTITION__"}
    names = [(p.parent.name, p.name[-20:]) for p in after]
    assert len(names) == len(before)  # still one file a bucket and day


def test_marks_sync_and_refresh(spark, frame, stored):
    ids = frame("id string, submission_id string", [("i1", "sub"), ("i1", "later"), ("i2", None), ("none", "x"), (None, "y")])
    assert bucketed.mark_uploaded(spark, stored, ids, "set", SCHEMA, NOW) == 2
    assert bucketed.mark_submitted(spark, stored, ids, SCHEMA, NOW) == 2
    got = spark.table(stored).filter("updated_at IS NOT NULL").select("id", "uploaded_at", "upload_source", "submitted_at", "submission_id", "workflow_state")
    moment = at("2024-06-01")
    assert table(got) == [("i1", moment, "set", moment, "later", "Submitted"), ("i2", moment, "set", moment, None, "Submitted")]
    value = F.struct(F.lit("9.5").alias("value"), F.lit(True).alias("propagate"))
    changes = frame("id string, sample_id string", [("i3", "s3"), (None, "s4")]).withColumn("new_total", value)
    assert bucketed.apply_sync(spark, stored, changes, SCHEMA, NOW) == 1
    refreshed = frame("id string, workflow_id string, workflow_state string", [("i4", "w", "Failed")])
    assert bucketed.apply_refresh(spark, stored, refreshed, SCHEMA, NOW) == 1
    got = spark.table(stored).filter("id IN ('i3', 'i4')").select("id", "total", "workflow_id", "workflow_state")
    assert table(got) == [("i3", 9.5, None, None), ("i4", 4.0, "w", "Failed")]
    assert spark.table(stored).count() == 60


def test_refusals(spark, frame, stored):
    with pytest.raises(ValueError, match="already exists"):
        bucketed.create_bucketed(spark, stored, SCHEMA, 4, exists_ok=False)
    assert not bucketed.create_bucketed(spark, stored, SCHEMA, 4)
    with pytest.raises(ValueError, match="columns differ"):
        bucketed.append_bucketed(rows(spark).withColumn("more", F.lit(1)), stored)
    with pytest.raises(ValueError, match="columns differ"):
        bucketed.append_bucketed(rows(spark).drop("total"), stored)
    with pytest.raises(ValueError, match="decide where"):
        bucketed.write_settled(spark, stored, bucketed.settled_values(rows(spark), {"created_at": F.lit(NOW)}), SCHEMA)
    nothing = frame("id string", [])
    assert bucketed.mark_uploaded(spark, stored, nothing, "set", SCHEMA, NOW) == 0
    spark.range(1).write.mode("overwrite").saveAsTable("plain_table")
    with pytest.raises(ValueError, match="no buckets"):
        bucketed.bucket_count(spark, "plain_table")
    spark.sql("DROP TABLE plain_table")
    with pytest.raises(ValueError, match="needs id and created_at"):
        bucketed.create_bucketed(spark, "other", SchemaSpec.from_yaml("fields:\n  id: {type: string, primary_key: true}\n"), 4)
