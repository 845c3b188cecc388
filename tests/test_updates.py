import pytest
from conftest import at, table
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from samplyard.operators import update
from samplyard.schema import SchemaSpec

NOW = "2024-05-06 07:08:09"
SCHEMA = SchemaSpec.from_yaml("""
fields:
  id: {type: string, primary_key: true}
  state: {type: string}
  count: {type: integer}
  uploaded_at: {type: datetime}
  updated_at: {type: datetime}
""")
DDL = "id string, state string, count bigint, uploaded_at timestamp_ntz, updated_at timestamp_ntz"
RECORD = "id string, position bigint, changes map<string,string>"


@pytest.fixture
def samples(frame):
    return frame(DDL, [("u1", "Running", 1, None, None), ("u2", "Running", 2, at("2024-01-01"), None), ("u3", None, None, None, None)])


def run(samples, frame, records, **options):
    done = update.apply_records(samples, frame(RECORD, [(i, n, c) for n, (i, c) in enumerate(records)]), SCHEMA, NOW, **options)
    return {r["id"]: r for r in done.collect()}


def test_absent_fields_are_kept_and_matched_rows_stamped(samples, frame):
    rows = run(samples, frame, [("u1", {"state": "Succeeded", "uploaded_at": "2024-02-02 03:04:05"}), ("u2", {"state": "Failed"})])
    assert (rows["u1"]["state"], rows["u1"]["uploaded_at"], rows["u1"]["count"]) == ("Succeeded", at("2024-02-02 03:04:05"), 1)
    assert (rows["u2"]["state"], rows["u2"]["uploaded_at"]) == ("Failed", at("2024-01-01"))
    assert rows["u1"]["updated_at"] == rows["u2"]["updated_at"] == at(NOW) and rows["u3"]["updated_at"] is None


def test_nulls_clear_only_when_allowed(samples, frame):
    records = [("u1", {"state": None})]
    kept = run(samples, frame, records)["u1"]
    assert kept["state"] == "Running" and kept["updated_at"] is None
    cleared = run(samples, frame, records, allow_nulls=True)["u1"]
    assert cleared["state"] is None and cleared["updated_at"] == at(NOW)


def test_rows_without_id_or_fields_are_ignored(samples, frame):
    rows = run(samples, frame, [(None, {"state": "x"}), ("u1", {}), ("u2", {"id": "u9"}), ("nobody", {"state": "x"})])
    assert {r["state"] for r in rows.values()} == {"Running", None} and len(rows) == 3


def test_unknown_field_fails_the_call(samples, frame):
    with pytest.raises(Exception, match="fields not in schema: nope"):
        run(samples, frame, [("u1", {"state": "x"}), ("u2", {"nope": "1"})])


def test_values_take_the_declared_type(samples, frame):
    rows = run(samples, frame, [("u1", {"count": "7.0", "uploaded_at": "2024-02-02T03:04:05Z"}), ("u2", {"count": "x"})])
    assert rows["u1"]["count"] == 7 and rows["u1"]["uploaded_at"] == at("2024-02-02 03:04:05") and rows["u2"]["count"] is None


def test_first_record_wins_in_a_batch_last_batch_wins_across(samples, frame):
    records = [("u1", {"state": "a", "count": "1"}), ("u1", {"state": "b"}), ("u2", {"state": "x"}), ("u1", {"state": "c"}), ("u1", {"state": "d", "count": "9"})]
    one = run(samples, frame, records)["u1"]
    assert (one["state"], one["count"]) == ("a", 1)
    batches = run(samples, frame, records, batch_size=2)["u1"]
    assert (batches["state"], batches["count"]) == ("d", 9)
    last_without_count = run(samples, frame, records[:4], batch_size=2)["u1"]
    assert (last_without_count["state"], last_without_count["count"]) == ("c", 1)


RECORDS = st.lists(
    st.tuples(
        st.sampled_from(["u1", "u2", "u3", "u9", None]),
        st.dictionaries(st.sampled_from(["state", "count"]), st.sampled_from(["1", "2", "3", None]), max_size=2),
    ),
    max_size=12,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(RECORDS, st.booleans(), st.integers(1, 5))
def test_against_a_plain_model(samples, frame, records, allow_nulls, batch_size):
    model = {r["id"]: r.asDict() for r in samples.collect()}
    usable = [(i, {k: v for k, v in c.items() if allow_nulls or v is not None}) for i, c in records]
    usable = [(n, i, c) for n, (i, c) in enumerate(usable) if i and c]
    for batch in sorted({n // batch_size for n, _, _ in usable}):
        written = set()
        for n, i, changes in usable:
            if n // batch_size == batch and i in model:
                for field, value in changes.items():
                    if (i, field) not in written:
                        written.add((i, field))
                        model[i][field] = int(value) if field == "count" and value else value
                model[i]["updated_at"] = at(NOW)
    got = run(samples, frame, records, allow_nulls=allow_nulls, batch_size=batch_size)
    assert {k: v.asDict() for k, v in got.items()} == model


def test_accounting(samples, frame):
    records = frame(RECORD, [("u1", 0, {"state": "a"}), ("u1", 1, {"state": "b"}), ("zz", 2, {"state": "c"}), ("u2", 3, {}), (None, 4, {"state": "d"}), ("u2", 5, {"nope": "1"})])
    assert table(update.accounting(samples, records, SCHEMA, batch_size=3)) == [(0, 2, 1, 0), (1, 0, 0, 3)]


def test_wide_rows_become_records(frame):
    df = frame("id string, a string, b int", [("1", "x", None), ("2", None, None)])
    records = update.change_records(df, {"a": F.col("a"), "b": F.col("b")})
    assert [r["changes"] for r in records.orderBy("id").collect()] == [{"a": "x", "b": None}, {"a": None, "b": None}]


def test_marks(frame):
    df = frame("id string, uploaded_at timestamp_ntz, upload_source string, submitted_at timestamp_ntz, submission_id string, workflow_state string, updated_at timestamp_ntz",
               [("1", None, None, None, None, None, None), ("2", None, None, None, None, None, None)])
    ids = frame("id string, submission_id string", [("1", "sub"), ("7", "x")])
    up = update.mark_uploaded(df, ids.unionByName(ids), "set_x", NOW).orderBy("id").collect()
    assert (up[0]["uploaded_at"], up[0]["upload_source"], up[0]["updated_at"]) == (at(NOW), "set_x", at(NOW)) and up[1]["uploaded_at"] is None
    sub = update.mark_submitted(df, ids, NOW).orderBy("id").collect()
    assert (sub[0]["submission_id"], sub[0]["workflow_state"], sub[0]["submitted_at"]) == ("sub", "Submitted", at(NOW))
    assert sub[1]["workflow_state"] is None and len(sub) == 2


CONFIG = SchemaSpec.from_yaml("""
fields:
  id: {type: string, primary_key: true}
  name: {type: string}
  active: {type: boolean}
  transferred: {type: boolean}
  method: {type: json}
  created_at: {type: datetime}
  updated_at: {type: datetime}
  touched: {type: datetime, updated_datetime: true}
""")


@pytest.fixture
def configs(frame):
    ddl = "id string, name string, active boolean, transferred boolean, method string, created_at timestamp_ntz, updated_at timestamp_ntz, touched timestamp_ntz"
    return frame(ddl, [("1", "a", True, None, None, at("2020-01-01"), None, None), ("2", "a", False, False, None, at("2020-01-01"), None, None), ("3", "b", True, True, None, None, None, None)])


def test_update_one_config(configs):
    rows = update.update_config(configs, "1", {"id": "9", "created_at": "2030-01-01", "name": "new", "method": {"k": 1}}, CONFIG, NOW).orderBy("id").collect()
    assert (rows[0]["id"], rows[0]["name"], rows[0]["method"], rows[0]["created_at"]) == ("1", "new", '{"k": 1}', at("2020-01-01"))
    assert rows[0]["updated_at"] == rows[0]["touched"] == at(NOW) and rows[1]["updated_at"] is None
    with pytest.raises(ValueError):
        update.update_config(configs, "1", {"nope": 1}, CONFIG)


def test_config_flags(configs, frame):
    done = update.mark_transferred(configs, frame("id string", [("1",)]), NOW).orderBy("id").collect()
    assert [r["transferred"] for r in done] == [True, False, True]
    off = update.deactivate(configs, {"name": "a"}, NOW).orderBy("id").collect()
    assert [r["active"] for r in off] == [False, False, True]
    assert [r["updated_at"] for r in off] == [at(NOW), None, None]
    assert [r["id"] for r in update.delete_ids(configs, frame("id string", [("1",), (None,)])).orderBy("id").collect()] == ["2", "3"]


def test_a_repeated_id_updates_one_row_once(frame):
    samples = frame("id string, submitted_at timestamp_ntz, submission_id string, workflow_state string", [("a", None, None, None), ("b", None, None, None)])
    ids = frame("id string, submission_id string", [("a", "s2"), ("a", "s1"), ("a", "s1"), (None, "s9")])
    got = update.mark_submitted(samples, ids, "2024-01-01 00:00:00")
    assert sorted((r["id"], r["submission_id"]) for r in got.collect()) == [("a", "s1"), ("b", None)]
