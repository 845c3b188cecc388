"""Submission documents, workflows and status refresh."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import case
from checks.views import FLAT_WORKFLOWS, ORDERS_AS_OF
from samplyard.functions.columns import col
from samplyard.operators import workflows as ops
from samplyard.plans import status
from samplyard.sources import submissions

FLAT = f"flat AS ({FLAT_WORKFLOWS})"
LISTED = "entity_name IS NOT NULL AND workflow_id IS NOT NULL"


def documents(v):
    return submissions.parse_documents(v.submission_documents)


@case("parse_submissions", f"""
WITH {FLAT} SELECT DISTINCT submission_id, upload_source AS entity_name, submission_date, doc_status AS status
FROM flat WHERE upload_source IS NOT NULL AND doc_status <> 'Aborted'""")
def parse_submissions(v):
    return submissions.list_submissions(documents(v))


@case("explode_workflows", f"""
WITH {FLAT} SELECT submission_id, submission_date, upload_source, position, workflow_id, entity_name, coalesce(raw_status, 'Unknown') AS status
FROM flat WHERE {LISTED} AND coalesce(raw_status, '') <> 'Aborted'""")
def explode_workflows(v):
    return submissions.explode_workflows(documents(v))


LAST = """SELECT entity_name, arg_max(workflow_id, (submission_date, submission_id, position)) AS workflow_id,
       arg_max(coalesce(raw_status, 'Unknown'), (submission_date, submission_id, position)) AS status,
       arg_max(submission_id, (submission_date, submission_id, position)) AS submission_id"""


def last_row(condition):
    return f"""SELECT * FROM flat WHERE {condition}
        QUALIFY row_number() OVER (PARTITION BY entity_name ORDER BY submission_date DESC, submission_id DESC, position DESC) = 1"""


@case("attach_workflows", f"""
WITH {FLAT}, last AS ({last_row('entity_name IS NOT NULL')})
SELECT u.id, u.sample_id, coalesce(workflow_id, '') AS new_workflow_id, coalesce(raw_status, 'Unknown') AS new_state
FROM user_samples u JOIN last ON u.sample_id = last.entity_name""", ("user_samples",))
def attach_workflows(v):
    rows = submissions.explode_workflows(documents(v), skip_aborted=False, need_id=False)
    return ops.attach_workflows(v.user_samples, rows, "sample_id")


@case("workflows_by_entity", f"""
WITH {FLAT}, last AS ({last_row(LISTED + " AND coalesce(raw_status, '') <> 'Aborted'")})
SELECT entity_name, submission_id, workflow_id, coalesce(raw_status, 'Unknown') AS status
FROM last WHERE entity_name IN (SELECT sample_id FROM user_samples WHERE lab IS NOT NULL)""", ("user_samples",))
def workflows_by_entity(v):
    rows = submissions.explode_workflows(documents(v))
    wanted = v.user_samples.filter("lab IS NOT NULL").select(col("sample_id").alias("entity_name"))
    return ops.workflows_by_entity(rows, wanted).select("entity_name", "submission_id", "workflow_id", "status")


@case("backfill_submission", f"""
WITH {FLAT}, last AS ({last_row(LISTED + " AND raw_status = 'Succeeded'")})
SELECT u.id, u.sample_id, last.submission_id AS new_submission_id, workflow_id AS new_workflow_id,
       raw_status AS new_state, submission_date AS new_submitted_at
FROM user_samples u JOIN last ON u.sample_id = last.entity_name WHERE u.submission_id IS NULL""", ("user_samples",))
def backfill_submission(v):
    return ops.backfill_submissions(v.user_samples, submissions.explode_workflows(documents(v)), "sample_id")


OPEN = "coalesce(workflow_id, '') <> '' AND coalesce(workflow_state, '') NOT IN ('Succeeded', 'Failed', 'Aborted')"


@case("refresh_states", f"""
SELECT s.id, s.submission_id, s.workflow_id, coalesce(w.status, 'Unknown') AS new_state
FROM (SELECT * FROM samples WHERE {OPEN}) s JOIN order_workflows w ON s.submission_id = w.submission_id AND s.workflow_id = w.workflow_id""", ("samples", "order_workflows"))
def refresh_states(v):
    from samplyard.operators.lookup import incomplete_workflows

    open_ones = incomplete_workflows(v.samples, ORDERS_AS_OF, 10_000)
    return ops.refresh_states(open_ones, v.order_workflows)


REFRESHED = f"""
ours AS (SELECT s.* FROM samples s JOIN configs c ON s.config_id = c.id WHERE c.active),
pending AS (SELECT DISTINCT config_id, submission_id FROM ours
            WHERE coalesce(submission_id, '') <> '' AND coalesce(workflow_id, '') = ''),
step1 AS (SELECT o.id, o.config_id, o.sample_id, o.submission_id, a.entity_name IS NOT NULL AS attached,
                 CASE WHEN a.entity_name IS NOT NULL THEN coalesce(a.workflow_id, '') ELSE o.workflow_id END AS workflow_id,
                 CASE WHEN a.entity_name IS NOT NULL THEN coalesce(a.status, 'Unknown') ELSE o.workflow_state END AS workflow_state
          FROM ours o LEFT JOIN (SELECT w.*, p.config_id FROM order_workflows w JOIN pending p ON w.submission_id = p.submission_id) a
               ON o.sample_id = a.entity_name AND o.config_id = a.config_id),
step2 AS (SELECT s.id, s.config_id, s.attached, s.workflow_id, s.workflow_state, w.workflow_id IS NOT NULL AS found, w.status
          FROM step1 s LEFT JOIN order_workflows w
               ON {OPEN.replace('workflow_id', 's.workflow_id').replace('workflow_state', 's.workflow_state')}
                  AND s.submission_id = w.submission_id AND s.workflow_id = w.workflow_id),
refreshed AS (SELECT id, config_id, workflow_id, CASE WHEN found THEN coalesce(status, 'Unknown') ELSE workflow_state END AS workflow_state
              FROM step2 WHERE attached OR found)"""


@case("status_refresh", f"WITH {REFRESHED} SELECT id, config_id, workflow_id, workflow_state FROM refreshed", ("samples", "configs", "order_workflows"))
def status_refresh(v):
    return status.refresh(v.samples, v.order_workflows, v.configs.filter("active"), "sample_id", ORDERS_AS_OF, 10_000)


@case("status_counts", f"WITH {REFRESHED} SELECT config_id, workflow_state, count(*) AS samples FROM refreshed GROUP BY 1, 2", ("samples", "configs", "order_workflows"))
def status_counts(v):
    return status.state_counts(status_refresh(v))
