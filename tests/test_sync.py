import pytest
from conftest import at, table

from samplyard.operators import sync
from samplyard.plans import sync as plan
from samplyard.schema import SchemaSpec

SCHEMA = SchemaSpec.from_yaml("""
fields:
  id: {type: string, primary_key: true}
  well: {type: string, sample_identifier: true}
  config_id: {type: string, configuration_identifier: true}
  lab: {type: string, sync_field: true}
  note: {type: string, sync_field: true, column_mappings: [remark]}
  volume: {type: integer, sync_field: true}
  created_at: {type: datetime}
  updated_at: {type: datetime}
""")
NOW = "2024-05-06 00:00:00"


@pytest.fixture
def samples(frame):
    ddl = "id string, well string, lab string, note string, volume bigint, config_id string, created_at timestamp_ntz, updated_at timestamp_ntz"
    wells = [("k1", "A1", "Kiel", None), ("k2", "A2", None, "checked"), ("k3", "B7", "", "")]
    return frame(ddl, [(*w, 5, "c1", at("2024-05-01"), None) for w in wells])


@pytest.fixture
def source(frame):
    wells = [("B7", "Ulm", "", "5"), ("A1", "Kiel", None, "5.0"), ("H12", "Jena", "new well", "1"), ("A2", "Bonn", "late", "7")]
    return frame("`entity:w_id` string, lab string, remark string, volume string, config_id string", [(*w, "c1") for w in wells])


def changed(df, field):
    return [r["id"] for r in df.filter(f"field = '{field}'").orderBy("id").collect()]


def test_fill_mode(samples, source):
    got = sync.field_changes(samples, source, SCHEMA, SCHEMA.sync_fields, "well")
    assert {f: changed(got, f) for f in ("lab", "note", "volume")} == {"lab": ["k2", "k3"], "note": [], "volume": []}
    assert got.filter("NOT propagate").count() == 0


def test_overwrite_mode_compares_typed_values(samples, source):
    got = sync.field_changes(samples, source, SCHEMA, SCHEMA.sync_fields, "well", overwrite=True)
    assert {f: changed(got, f) for f in ("lab", "note", "volume")} == {"lab": ["k2", "k3"], "note": ["k2"], "volume": ["k2"]}


def test_equal_values_give_nothing(samples):
    same = samples.select("well", "lab", "note", "volume")
    assert sync.field_changes(samples, same, SCHEMA, SCHEMA.sync_fields, "well", overwrite=True).count() == 0


def test_clearing(frame):
    target = frame("id string, well string, lab string", [("k1", "A1", "Kiel"), ("k2", "A2", None), ("k3", "A3", "Ulm"), ("k4", "A4", "Bonn"), ("k5", "A5", "Jena")])
    src = frame("w string, lab string", [("A1", ""), ("A2", None), ("A3", None), ("A4", "Trier"), ("A5", "Jena")])
    ask = lambda **mode: table(sync.field_changes(target, src, SCHEMA, ["lab"], "well", **mode).select("id", "value", "propagate"))
    assert ask(overwrite=True) == [("k4", "Trier", True)]
    assert ask(overwrite=True, allow_null=True) == [("k1", None, False), ("k3", None, False), ("k4", "Trier", True)]
    assert ask(allow_null=True) == []


def test_first_source_row_by_tie_break_and_missing_wells(samples, frame):
    src = frame("w string, lab string, rank int", [("A1", "Mainz", 9), (None, "Kiel", 0), ("A1", "Worms", 4), ("Z9", "Kiel", 1)])
    got = sync.field_changes(samples, src, SCHEMA, SCHEMA.sync_fields, "well", overwrite=True, tie_break=["rank"])
    assert table(got.select("id", "field", "value")) == [("k1", "lab", "Worms")]


def test_identifier_may_stand_in_another_column(samples, frame):
    src = frame("`entity:w_id` string, label string, lab string", [("row-1", "B7", "Celle")])
    got = sync.field_changes(samples, src, SCHEMA, ["lab"], "well", source_key="label")
    assert table(got.select("id", "value")) == [("k3", "Celle")]


def test_whole_run(samples, source, frame):
    destination = frame("name string, config_id string, lab string, shelf string", [("A1", "c1", "Kiel", "s1"), ("A2", "c1", "?", "s2"), ("B7", "c2", "?", "s3")])
    configs = frame("id string", [("c1",), ("c9",)])
    done = plan.sync_all(samples, source, destination, configs, SCHEMA, "entity:w_id", "name", as_of=NOW)
    after = {r["id"]: (r["lab"], r["note"], r["updated_at"]) for r in done["samples"].collect()}
    assert after == {"k1": ("Kiel", None, None), "k2": ("Bonn", "checked", at(NOW)), "k3": ("Ulm", "", at(NOW))}
    assert table(done["destination"]) == [("A1", "c1", "Kiel", "s1"), ("A2", "c1", "Bonn", "s2"), ("B7", "c2", "?", "s3")]
    assert table(done["results"]) == [("c1", 2, 1, 1, "partial_success"), ("c9", 0, 0, 0, "no_updates")]


def test_look_back_and_foreign_configs_are_left_alone(samples, source, frame):
    configs = frame("id string", [("c1",)])
    old = plan.changes_for_configs(samples, source, configs, SCHEMA, "entity:w_id", as_of="2024-12-01 00:00:00")
    other = plan.changes_for_configs(samples, source, frame("id string", [("c2",)]), SCHEMA, "entity:w_id", as_of=NOW)
    assert old.count() == other.count() == 0
