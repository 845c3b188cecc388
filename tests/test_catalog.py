import uuid
import warnings

import pytest
from conftest import table

from samplyard.operators import sync
from samplyard.plans import sync as sync_plan
from samplyard.schema import SchemaSpec
from samplyard.sources import catalog


@pytest.fixture
def name(spark):
    made = f"t_{uuid.uuid4().hex}"
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made}")


def sheet(folder, name, text):
    (folder / name).write_text(text)
    return str(folder / name)


def test_upload_by_given_name_and_by_file(spark, tmp_path, name):
    path = sheet(tmp_path, f"{name}.tsv", "id\tn\tx\n1\t2\ta\n2\t3\tNA\n")
    assert catalog.upload_tables(spark, [path]) == [name]
    stored = spark.table(name)
    assert table(stored) == [(1, 2, "a"), (2, 3, None)] and [t for _, t in stored.dtypes] == ["int", "int", "string"]


def test_existing_tables_are_refused_before_anything_is_read(spark, tmp_path, name):
    first = sheet(tmp_path, "a.csv", "id,x\n1,a\n")
    other = f"{name}_other"
    catalog.upload_tables(spark, [first], [name])
    with pytest.raises(ValueError, match=f"tables exist: {name}"):
        catalog.upload_tables(spark, [first, first], [other, name])
    assert not spark.catalog.tableExists(other)
    second = sheet(tmp_path, "b.csv", "id,x\n7,z\n")
    catalog.upload_tables(spark, [second], [name], overwrite=True)
    assert table(spark.table(name)) == [(7, "z")]


def test_names_and_files_have_to_match(spark, tmp_path, name):
    path = sheet(tmp_path, "a.csv", "id\n1\n")
    with pytest.raises(ValueError, match="2 files but 1"):
        catalog.upload_tables(spark, [path, path], [name])
    with pytest.raises(ValueError, match="several files"):
        catalog.upload_tables(spark, [path, path])


def test_append_checks_the_schema(spark, frame, tmp_path, name):
    catalog.save_table(frame("id int, day string, x string", [(1, "d1", "a")]), name, partition_by=["day"], location=str(tmp_path / "t"))
    catalog.append_table(frame("x string, id int, day string", [("b", 2, "d2")]), name)
    assert table(spark.table(name).select("id", "day", "x")) == [(1, "d1", "a"), (2, "d2", "b")]
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {"day=d1", "day=d2"}
    with pytest.raises(ValueError, match="without day; unknown more; id is bigint, not int"):
        catalog.append_table(frame("id long, x string, more int", []), name)
    with pytest.raises(ValueError, match="no such columns"):
        catalog.save_table(frame("id int", []), f"{name}_2", partition_by=["day"])


SCHEMA = SchemaSpec.from_yaml("""
fields:
  id: {type: string, primary_key: true}
  sid: {type: string, sample_identifier: true}
  config_id: {type: string, configuration_identifier: true}
  created_at: {type: datetime}
  lab: {type: string, sync_field: true}
""")


def test_clearing_without_overwriting_is_told(frame):
    samples, source = frame("id string, sid string, lab string", [("1", "a", "x")]), frame("sid string, lab string", [("a", "")])
    with pytest.warns(UserWarning, match="allow_null does nothing"):
        changes = sync.sample_changes(samples, source, SCHEMA, ["lab"], "sid", allow_null=True)
    assert changes.count() == 0
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert sync.sample_changes(samples, source, SCHEMA, ["lab"], "sid", True, True).count() == 1


def test_a_table_is_not_synced_onto_itself(frame):
    samples = frame("id string, sid string, config_id string, created_at timestamp_ntz, lab string", [])
    source, configs = frame("sid string, config_id string, lab string", []), frame("id string", [])
    with pytest.raises(ValueError, match="the same table"):
        sync_plan.sync_all(samples, source, source.select("*"), configs, SCHEMA, "sid", "sid", as_of="2024-01-01")
