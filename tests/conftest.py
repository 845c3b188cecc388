import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from samplyard.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "samplyard-tests",
        "local[8]",
        spark__sql__shuffle__partitions=4,
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a small frame from a DDL schema and rows."""

    def build(schema, rows):
        return spark.createDataFrame(rows, schema)

    return build


def at(text):
    return datetime.fromisoformat(text)


def table(df, *order):
    """All rows as tuples, sorted by the text of the given (or all) columns."""
    order = order or df.columns
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [str(r[df.columns.index(o)]) for o in order])


def values(df, column=None):
    column = column or df.columns[0]
    return sorted((r[column] for r in df.select(f"`{column}`").collect()), key=str)
