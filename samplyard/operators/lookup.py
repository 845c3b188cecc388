"""Predicates and lookups over the ``samples`` and ``configs`` tables.

Every filter is a plain column predicate, so it reaches the scan; a filter on the creation time also
names the day folders it implies, so the others are not opened.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplyard.functions.columns import col, cols, filled, is_blank
from samplyard.operators.clean import moment
from samplyard.operators.joins import distinct_keys, top_per_key, with_keys

# States after which a workflow does not change any more.
FINAL_STATES = ("Succeeded", "Failed", "Aborted")
#: The partition column of a stored samples table: the day of ``created_at``.
DAY = "created_date"


def _bounds(timeframe, as_of, days_back, hours_back, start, end) -> tuple[Column, Column | None, bool]:
    """First moment, last one (null: open) and whether the last belongs to the timeframe."""
    now = moment(as_of)
    today = now.cast("date").cast("timestamp_ntz")

    def days(n: int) -> Column:
        return F.make_dt_interval(days=F.lit(n))

    def hours(n: int) -> Column:
        return F.make_dt_interval(hours=F.lit(n))

    frame = (timeframe or "today").lower()
    if frame == "yesterday":
        return today - days(1), today, False
    if frame == "week":
        return today - days(7), None, False
    if frame == "month":
        return today - days(30), None, False
    if frame == "hourly":
        return now - hours(1 if hours_back is None else hours_back), None, False
    if frame == "custom":
        if hours_back is not None:
            return now - hours(hours_back), None, False
        if days_back is not None:
            return today - days(days_back), None, False
        if start and end:
            return moment(start), moment(end), True
        if start:
            return moment(start), None, False
    return today, today + days(1), False


def created_within(
    timeframe: str | None = "today",
    as_of: datetime | str | None = None,
    days_back: int | None = None,
    hours_back: int | None = None,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    column: str = "created_at",
) -> Column:
    """Rows created in a timeframe: today, yesterday, week, month, hourly or custom.

    Custom looks at hours, then days, then start and end (both included), then start alone.
    Anything else means today. Bounds are compared with the bare column, so they can be pushed
    into the scan.
    """
    low, high, closed = _bounds(timeframe, as_of, days_back, hours_back, start, end)
    found = col(column) >= low
    if high is None:
        return found
    return found & ((col(column) <= high) if closed else (col(column) < high))


def day_folders(df: DataFrame, low: Column, high: Column | None = None) -> DataFrame:
    """Only the day folders that can hold rows created from ``low`` to ``high``, if ``df`` has them.

    The day follows from the creation time, so no row is lost; scans skip the other folders.
    """
    if DAY not in df.columns:
        return df
    df = df.filter(col(DAY) >= low.cast("date"))
    return df if high is None else df.filter(col(DAY) <= high.cast("date"))


def in_timeframe(df: DataFrame, timeframe: str | None = "today", as_of=None, **window) -> DataFrame:
    """The rows of :func:`created_within`, read from the day folders it implies."""
    given = {"days_back": None, "hours_back": None, "start": None, "end": None} | {k: v for k, v in window.items() if k != "column"}
    low, high, _ = _bounds(timeframe, as_of, **given)
    found = df.filter(created_within(timeframe, as_of, **window))
    return day_folders(found, low, high) if window.get("column", "created_at") == "created_at" else found


def created_since(df: DataFrame, low: Column) -> DataFrame:
    return day_folders(df.filter(col("created_at") >= low), low)


def in_stage(uploaded: str | None = "not_uploaded", submitted: str | None = "not_submitted") -> Column:
    """Life-cycle filter. ``uploaded=None`` means not uploaded, ``submitted=None`` means all."""
    keep = F.lit(True)
    uploaded = (uploaded or "not_uploaded").lower()
    submitted = (submitted or "all").lower()
    if uploaded in ("not_uploaded", "uploaded"):
        at = col("uploaded_at")
        keep = keep & (at.isNull() if uploaded == "not_uploaded" else at.isNotNull())
    if submitted in ("not_submitted", "submitted"):
        at = col("submitted_at")
        keep = keep & (at.isNull() if submitted == "not_submitted" else at.isNotNull())
    return keep


def samples_in(
    samples: DataFrame,
    timeframe: str | None = "today",
    as_of=None,
    uploaded: str | None = "not_uploaded",
    submitted: str | None = "not_submitted",
    config_id: str | None = None,
    set_name: str | None = None,
    config_key: str = "config_id",
    newest_first: bool = True,
    **window,
) -> DataFrame:
    """Samples of a timeframe and life-cycle stage, newest first."""
    found = in_timeframe(samples, timeframe, as_of, **window).filter(in_stage(uploaded, submitted))
    if config_id:
        found = found.filter(col(config_key) == config_id)
    if set_name:
        found = found.filter(col("upload_source") == set_name)
    return found.orderBy(col("created_at").desc()) if newest_first else found


def created_today(samples: DataFrame, as_of=None) -> DataFrame:
    return samples_in(samples, "today", as_of)


def recent_hours(samples: DataFrame, hours: int = 1, uploaded: str = "not_uploaded", as_of=None) -> DataFrame:
    return samples_in(samples, "hourly", as_of, uploaded, hours_back=hours)


def ready_for_submission(samples: DataFrame, timeframe: str = "today", as_of=None, **filters) -> DataFrame:
    """Uploaded, not yet submitted."""
    return samples_in(samples, timeframe, as_of, "uploaded", "not_submitted", **filters)


def query_samples(
    samples: DataFrame,
    conditions: Sequence[str | Column] = (),
    parameters: Mapping[str, Any] | None = None,
    fields: Sequence[str] | None = None,
    order_by: str | None = "created_at DESC",
    limit: int | None = None,
) -> DataFrame:
    """Generic select: all conditions must hold; SQL text may use ``@name`` or ``:name``.

    Parameter values are bound as literals and never pasted into the text.
    """
    view = samples
    for condition in conditions:
        if isinstance(condition, Column):
            view = view.filter(condition)
        else:
            text, bound = _bind(condition, parameters or {})
            view = view.sparkSession.sql(f"SELECT * FROM {{rows}} WHERE {text}", args=bound, rows=view)
    if order_by:
        view = view.orderBy(*[_ordering(part) for part in order_by.split(",")])
    if limit:
        view = view.limit(limit)
    return view.select(*cols(fields)) if fields else view


def _bind(condition: str, parameters: Mapping[str, Any]) -> tuple[str, dict[str, Any]]:
    """The condition with ``:name`` for each parameter, and the parameters it uses; quoted text and
    names that are no parameters stay as they are."""
    used: dict[str, Any] = {}

    def place(found: re.Match) -> str:
        name = found.group(2)
        if name is None or name not in parameters:
            return found.group(0)
        used[name] = parameters[name]
        return f":{name}"

    return re.sub(r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`)|[@:](\w+)""", place, condition), used


def _ordering(part: str) -> Column:
    name, _, direction = part.strip().partition(" ")
    return col(name).desc() if direction.strip().upper() == "DESC" else col(name).asc()


def existing_identifiers(samples: DataFrame, identifier: str, config_id: str | None = None, config_key: str = "config_id") -> DataFrame:
    """Distinct identifiers present, optionally of one config."""
    rows = samples if config_id is None else samples.filter(col(config_key) == config_id)
    return distinct_keys(rows, [identifier])


def recent_not_uploaded(samples: DataFrame, k: int, config_key: str = "config_id") -> DataFrame:
    """Newest ``k`` samples per config that are not uploaded yet; ties go by id."""
    waiting = samples.filter(col("uploaded_at").isNull())
    return top_per_key(waiting, [config_key], [col("created_at").desc(), col("id").asc()], k)


def unique_submissions(
    samples: DataFrame,
    as_of=None,
    days_back: int = 30,
    need_workflow_id: bool = True,
    config_key: str = "config_id",
    submission: str = "submission_id",
    workflow: str = "workflow_id",
) -> DataFrame:
    """Distinct (config, submission) seen in the look-back, by default only those lacking a workflow id."""
    now = moment(as_of)
    rows = created_since(samples.filter(filled(col(submission))), now - F.make_dt_interval(days=F.lit(days_back)))
    if need_workflow_id:
        rows = rows.filter(is_blank(col(workflow)))
    return rows.select(col(config_key), col(submission)).distinct()


def by_entity_names(samples: DataFrame, names: DataFrame, identifier: str, config_key: str = "config_id") -> DataFrame:
    """Samples whose (config, identifier) is listed in ``names``."""
    return with_keys(samples, names, [config_key, identifier])


def is_running(workflow: str = "workflow_id", state: str = "workflow_state") -> Column:
    """A workflow that has not reached a final state."""
    return filled(col(workflow)) & (is_blank(col(state)) | ~col(state).isin(*FINAL_STATES))


def incomplete_workflows(
    samples: DataFrame,
    as_of=None,
    days_back: int = 30,
    limit: int | None = None,
    workflow: str = "workflow_id",
    state: str = "workflow_state",
    config_key: str = "config_id",
) -> DataFrame:
    """Samples with a workflow that has not reached a final state; ``limit`` is per config."""
    now = moment(as_of)
    rows = created_since(samples.filter(is_running(workflow, state)), now - F.make_dt_interval(days=F.lit(days_back)))
    if limit is None:
        return rows
    return top_per_key(rows, [config_key], [col("created_at").desc(), col("id").asc()], limit)


def find_configs(
    configs: DataFrame,
    active_only: bool = False,
    entity_type: str | None = None,
    skip_transferred: bool = False,
    newest_first: bool = True,
) -> DataFrame:
    """Configs by flag and entity type; a null transfer flag counts as not transferred."""
    rows = configs
    if active_only:
        rows = rows.filter(col("active"))
    if entity_type:
        rows = rows.filter(col("entity_type") == entity_type)
    if skip_transferred:
        rows = rows.filter(~F.coalesce(col("transferred"), F.lit(False)))
    return rows.orderBy(col("created_at").desc()) if newest_first else rows


def config_by_id(configs: DataFrame, config_id: str) -> DataFrame:
    return configs.filter(col("id") == config_id).limit(1)


def existing_types(configs: DataFrame) -> DataFrame:
    return configs.filter(filled(col("entity_type"))).select("entity_type").distinct()
