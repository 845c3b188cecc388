import json

import pytest
from conftest import at, table, values

from samplyard.operators import workflows as ops
from samplyard.plans import status
from samplyard.sources import submissions

DOCS = [
    {"submissionId": "s1", "status": "Done", "submissionDate": "2024-02-18T10:00:00Z", "submissionEntity": {"entityName": "set1"},
     "workflows": [
         {"workflowId": "w1", "status": "Succeeded", "workflowEntity": {"entityName": "a"}},
         {"workflowId": "w2", "status": "Failed", "workflowEntity": {"entityName": "a"}},
         {"status": "Running", "workflowEntity": {"entityName": "b"}},
         {"workflowId": "w4", "workflowEntity": {"entityName": "c"}},
         {"workflowId": "w5", "status": "Aborted", "workflowEntity": {"entityName": "d"}},
         {"workflowId": "w6", "status": "Running"},
     ]},
    {"submissionId": "s2", "status": "Aborted", "submissionDate": "2024-02-19T10:00:00Z", "submissionEntity": {"entityName": "set2"},
     "workflows": [{"workflowId": "w7", "status": "Succeeded", "workflowEntity": {"entityName": "c"}}]},
    {"submissionId": "s3", "status": "Done", "submissionDate": "2024-02-20T10:00:00.123Z", "submissionEntity": {}, "workflows": []},
]


@pytest.fixture
def documents(frame):
    return submissions.parse_documents(frame("value string", [(json.dumps(d),) for d in DOCS]))


def test_list_of_submissions(documents):
    assert table(submissions.list_submissions(documents)) == [("s1", "set1", at("2024-02-18T10:00:00"), "Done")]
    assert values(submissions.list_submissions(documents, skip_aborted=False), "submission_id") == ["s1", "s2"]


def test_workflow_rows(documents):
    rows = submissions.explode_workflows(documents)
    assert table(rows.select("workflow_id", "entity_name", "status", "position", "upload_source")) == [
        ("w1", "a", "Succeeded", 0, "set1"), ("w2", "a", "Failed", 1, "set1"), ("w4", "c", "Unknown", 3, "set1"), ("w7", "c", "Succeeded", 0, "set2")
    ]
    assert "w5" in values(submissions.explode_workflows(documents, skip_aborted=False), "workflow_id")


def test_last_workflow_of_an_entity_is_attached(documents, frame):
    rows = submissions.explode_workflows(documents, skip_aborted=False, need_id=False)
    samples = frame("id string, name string", [(n, n) for n in "abcdz"])
    assert table(ops.attach_workflows(samples, rows, "name").drop("name")) == [
        ("a", "w2", "Failed"), ("b", "", "Running"), ("c", "w7", "Succeeded"), ("d", "w5", "Aborted")
    ]


def test_by_entity(documents, frame):
    rows = submissions.explode_workflows(documents)
    got = ops.workflows_by_entity(rows, frame("entity_name string", [("a",), ("a",), ("c",), ("q",)]))
    assert table(got.select("entity_name", "workflow_id")) == [("a", "w2"), ("c", "w7")]


def test_backfill_takes_the_newest_success(documents, frame):
    samples = frame("id string, name string, submission_id string", [("1", "a", None), ("2", "c", None), ("3", "c", "have"), ("4", "d", None)])
    got = ops.backfill_submissions(samples, submissions.explode_workflows(documents), "name")
    assert table(got.select("id", "new_submission_id", "new_workflow_id")) == [("1", "s1", "w1"), ("2", "s2", "w7")]


def test_backfill_column_by_key(frame):
    target = frame("k string, day string", [("a", None), ("b", "have"), ("c", None), (None, None)])
    other = frame("name string, day string, n int", [("a", "second", 2), ("a", "first", 1), ("b", "x", 1), (None, "y", 1)])
    assert table(ops.backfill_column(target, other, "day", "k", "name", "n")) == [(None, None), ("a", "first"), ("b", "have"), ("c", None)]


def test_refresh_of_all_configs(frame):
    ddl = "id string, sample_id string, config_id string, created_at timestamp_ntz, submission_id string, workflow_id string, workflow_state string, updated_at timestamp_ntz"
    day = at("2024-05-01")
    samples = frame(ddl, [
        ("1", "a", "c1", day, "s1", None, "Submitted", None),      # gets its workflow, which is done
        ("2", "b", "c1", day, "s1", None, "Submitted", None),      # aborted workflow is recorded
        ("3", "c", "c1", day, "s2", "w3", "Running", None),        # refreshed by id
        ("4", "d", "c1", day, "s2", "w4", "Succeeded", None),      # final, left alone
        ("5", "e", "c2", day, "s3", None, "Submitted", None),      # config not listed
        ("6", "f", "c1", day, "s1", None, "Submitted", None),      # no workflow
    ])
    workflows = frame("submission_id string, submission_date timestamp_ntz, position bigint, workflow_id string, entity_name string, status string", [
        ("s1", day, 0, "w1", "a", "Succeeded"), ("s1", day, 1, "w2", "b", "Aborted"),
        ("s2", day, 0, "w3", "c", "Failed"), ("s2", day, 1, "w4", "d", "Failed"), ("s3", day, 0, "w5", "e", "Failed"),
    ])
    got = status.refresh(samples, workflows, frame("id string", [("c1",)]), "sample_id", "2024-05-06 00:00:00")
    assert table(got) == [("1", "c1", "w1", "Succeeded"), ("2", "c1", "w2", "Aborted"), ("3", "c1", "w3", "Failed")]
    assert table(status.state_counts(got)) == [("c1", "Aborted", 1), ("c1", "Failed", 1), ("c1", "Succeeded", 1)]
    after = status.apply_refresh(samples, got, "2024-05-06 00:00:00")
    assert [r["workflow_state"] for r in after.orderBy("id").collect()] == ["Succeeded", "Aborted", "Failed", "Succeeded", "Submitted", "Submitted"]
