import pytest
from conftest import at, values

from samplyard.operators import lookup
from samplyard.sources import grouped

DDL = "id string, config_id string, created_at timestamp_ntz, workflow_id string, workflow_state string"
NOW = "2024-01-31 00:00:00"


@pytest.fixture
def stored(spark, frame, tmp_path):
    states = ["Running", "", None, "Failed", "Succeeded"]
    rows = [(f"i{n}", f"c{n % 40}", at(f"2024-01-{1 + n % 28:02}"), f"w{n}" if n % 7 else None, states[n % 5]) for n in range(400)]
    rows += [("x", None, at("2024-01-20"), "w", "Running"), ("y", "c3", None, "w", "Running")]
    df = frame(DDL, rows)
    grouped.append_grouped(df, str(tmp_path / "t"), groups=16)
    return str(tmp_path / "t"), df


def test_equals_the_plain_look_back(spark, frame, stored):
    path, df = stored
    samples, groups = grouped.read_grouped(spark, path)
    assert groups == 16 and samples.count() == df.count()
    configs = frame("id string, active boolean", [("c3", True), ("c17", True), ("c5", False), ("c6", None), (None, True)])
    got = grouped.incomplete_of_active(samples, groups, configs, NOW, days_back=14)
    wanted = lookup.incomplete_workflows(df.filter("config_id IN ('c3', 'c17')"), NOW, 14)
    assert values(got, "id") == values(wanted, "id") != []
    limited = grouped.incomplete_of_active(samples, groups, configs, NOW, days_back=14, limit=1)
    assert values(limited, "id") == values(lookup.incomplete_workflows(df.filter("config_id IN ('c3', 'c17')"), NOW, 14, 1), "id")


def test_active_configs_prune_the_scan(spark, frame, stored, tmp_path):
    path, _ = stored
    frame("id string, active boolean", [("c3", True), ("c5", False)]).write.parquet(str(tmp_path / "configs"))
    samples, groups = grouped.read_grouped(spark, path)
    found = grouped.incomplete_of_active(samples, groups, spark.read.parquet(str(tmp_path / "configs")), NOW, days_back=14)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "config_group" in line)
    assert "dynamicpruning" in scan.split("PartitionFilters")[1] and "created_date" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_refusals(spark, frame, stored, tmp_path):
    path, df = stored
    with pytest.raises(ValueError, match="has 16 groups, not 8"):
        grouped.append_grouped(df, path, groups=8)
    grouped.append_grouped(df, path, groups=16)
    assert grouped.read_grouped(spark, path)[0].count() == 2 * df.count()
    with pytest.raises(ValueError, match="no grouped table"):
        grouped.read_grouped(spark, str(tmp_path / "none"))
