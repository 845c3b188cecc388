from datetime import date, datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from samplyard.functions.dates import format_date, parse_utc, parse_wall, spark_pattern
from samplyard.functions.types import coerce

WALL = {
    "2024-01-15": datetime(2024, 1, 15),
    "01/15/2024": datetime(2024, 1, 15),
    "15/01/2024": datetime(2024, 1, 15),
    "03/04/2024": datetime(2024, 3, 4),
    "1/5/2024": datetime(2024, 1, 5),
    "2024/01/15": datetime(2024, 1, 15),
    "20240115": datetime(2024, 1, 15),
    "20240115T103045": datetime(2024, 1, 15, 10, 30, 45),
    "2024-01-15 10:30:45": datetime(2024, 1, 15, 10, 30, 45),
    "01/15/2024 10:30:45": datetime(2024, 1, 15, 10, 30, 45),
    "15/01/2024 10:30:45": datetime(2024, 1, 15, 10, 30, 45),
    "2024-01-15T10:30:45": datetime(2024, 1, 15, 10, 30, 45),
    "2024-01-15T10:30:45Z": datetime(2024, 1, 15, 10, 30, 45),
    "2024-01-15T10:30:45.123456": datetime(2024, 1, 15, 10, 30, 45, 123456),
    "2024-01-15T10:30:45.1234567Z": datetime(2024, 1, 15, 10, 30, 45, 123456),
    "2024-01-15T10:30:45+05:30": datetime(2024, 1, 15, 10, 30, 45),
    "2024-01-15 10:30": datetime(2024, 1, 15, 10, 30),
    "2024-01-15T10": datetime(2024, 1, 15, 10),
    "  2024-01-15  ": datetime(2024, 1, 15),
    "Jan 15, 2024": datetime(2024, 1, 15),
    "January 15, 2024": datetime(2024, 1, 15),
    "15 Jan 2024": datetime(2024, 1, 15),
    "5-Sep-2024": datetime(2024, 9, 5),
    "Sept 5 2024 07:08": datetime(2024, 9, 5, 7, 8),
    "1/5/24": datetime(2024, 1, 5),
    "1/5/99": datetime(1999, 1, 5),
    "2024-W03-1": datetime(2024, 1, 15),
    "2020W537": datetime(2021, 1, 3),
    "2024": datetime(2024, 1, 1),
    "2024-02-30": None,
    "02/30/2024": None,
    "31/31/2024": None,
    "": None,
    "   ": None,
    "not a date": None,
    "12345": None,
}


def parsed(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]


def test_cascade(spark):
    got = parsed(spark, list(WALL), parse_wall)
    assert dict(zip(WALL, got)) == WALL


def test_null_stays_null(spark):
    assert parsed(spark, [None], parse_wall) == [None]


def test_zone_moves_to_utc_in_zoneless_columns(spark):
    texts = ["2024-01-15T10:30:45+05:30", "2024-01-15T10:30:45-0800", "2024-01-15T23:30:00-01", "2024-01-15T10:30:45Z", "2024-01-15"]
    assert parsed(spark, texts, parse_utc) == [
        datetime(2024, 1, 15, 5, 0, 45),
        datetime(2024, 1, 15, 18, 30, 45),
        datetime(2024, 1, 16, 0, 30),
        datetime(2024, 1, 15, 10, 30, 45),
        datetime(2024, 1, 15),
    ]
    assert parsed(spark, texts[2:3], lambda c: coerce(c, "date")) == [date(2024, 1, 15)]


@pytest.mark.parametrize(
    "layout, text, wanted",
    [
        ("ISO 8601", "01/15/2024", "2024-01-15T00:00:00"),
        ("RFC3339", "2024-01-15T10:30:45Z", "2024-01-15T10:30:45+00:00"),
        ("ISO8601", "2024-01-15T10:30:45.5+05:30", "2024-01-15T10:30:45.500000+05:30"),
        ("YYYY-MM-DD", "01/15/2024", "2024-01-15"),
        ("MM/DD/YYYY", "2024-01-15", "01/15/2024"),
        ("DD/MM/YYYY", "2024-01-15", "15/01/2024"),
        ("YYYY/MM/DD", "20240115", "2024/01/15"),
        ("%d.%m.%y %H:%M", "2024-01-15T10:30:45Z", "15.01.24 10:30"),
        ("%B %d, %Y", "2024-01-15", "January 15, 2024"),
        ("%Y%m%d_%H%M%S", "2024-01-15 01:02:03", "20240115_010203"),
        ("%Y-%j", "2024-02-01", "2024-032"),
        ("on %Y", "2024-02-01", "on 2024"),
    ],
)
def test_layouts(spark, layout, text, wanted):
    assert parsed(spark, [text], lambda c: format_date(c, layout)) == [wanted]


def test_own_layout_is_tried_first(spark):
    # As written by the field's layout this is 3 April, month first it would be 4 March.
    assert parsed(spark, ["03/04/2024", "2024-04-03"], lambda c: parse_wall(c, "%d/%m/%Y")) == [datetime(2024, 4, 3)] * 2
    assert parsed(spark, ["3.4.2024"], lambda c: parse_wall(c, "%d.%m.%Y")) == [datetime(2024, 4, 3)]


def test_unknown_directive_is_refused():
    with pytest.raises(ValueError):
        spark_pattern("%Y %Z")


LAYOUTS = ["%Y-%m-%d", "%m/%d/%Y", "%Y/%m/%d", "%Y-%m-%d %H:%M:%S", "%m/%d/%Y %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%SZ", "%Y%m%d"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 40_000 * 86_400), min_size=20, max_size=60))
def test_every_listed_layout_reads_back(spark, seconds):
    moments = [datetime(1970, 1, 1) + timedelta(seconds=s) for s in seconds]
    texts, wanted = [], []
    for moment in moments:
        for layout in LAYOUTS:
            text = moment.strftime(layout)
            texts.append(text)
            wanted.append(datetime.strptime(text, layout))
    assert parsed(spark, texts, parse_wall) == wanted
