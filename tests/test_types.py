import math
from datetime import date, datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from samplyard.functions.types import coerce


def column(spark, texts, kind, ddl="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, t {ddl}")
    return [r[0] for r in df.orderBy("i").select(coerce(F.col("t"), kind, df.schema["t"].dataType)).collect()]


def test_integers(spark):
    texts = ["7", " 8 ", "3.0", "1e3", "1.5", "", None, "nan", "inf", "x", "9007199254740993", "99999999999999999999", "-4", "7d"]
    assert column(spark, texts, "integer") == [7, 8, 3, 1000, None, None, None, None, None, None, 9007199254740993, None, -4, None]


def test_floats(spark):
    got = column(spark, ["1.5", "1e3", ".5", "5.", "-2", "nan", "", None, "1f", "0x10", "yes"], "float")
    assert got == [1.5, 1000.0, 0.5, 5.0, -2.0, None, None, None, None, None, None]
    assert math.isinf(column(spark, ["inf"], "float")[0])


def test_booleans_take_exact_texts_only(spark):
    texts = ["true", "True", "TRUE", "1", "false", "False", "FALSE", "0", "yes", "tRUE", "", None, "t"]
    assert column(spark, texts, "boolean") == [True] * 4 + [False] * 4 + [None] * 5


def test_dates_and_times(spark):
    assert column(spark, ["01/15/2024", "bad"], "date") == [date(2024, 1, 15), None]
    assert column(spark, ["2024-01-15T10:00:00Z", ""], "datetime") == [datetime(2024, 1, 15, 10), None]
    naive = column(spark, ["2024-01-15 10:00:00"], "timestamp")[0]
    assert naive.astimezone(timezone.utc).replace(tzinfo=None) == datetime(2024, 1, 15, 10)


def test_typed_input_passes(spark):
    assert column(spark, [1, None], "integer", "int") == [1, None]
    assert column(spark, [1, 2], "float", "int") == [1.0, 2.0]
    assert column(spark, [True, None], "boolean", "boolean") == [True, None]
    assert column(spark, [1, 0], "boolean", "int") == [True, False]
    assert column(spark, [12, None], "string", "int") == ["12", None]
    assert column(spark, [datetime(2024, 1, 15, 10)], "date", "timestamp_ntz") == [date(2024, 1, 15)]


def test_nested_values_become_json_text(spark):
    df = spark.createDataFrame([(["a", "b"],)], "t array<string>")
    assert df.select(coerce(F.col("t"), "json", T.ArrayType(T.StringType()))).first()[0] == '["a","b"]'


def test_utc_times_ignore_the_sessions_clock_changes(spark):
    from samplyard.functions.dates import utc_instant, utc_wall

    zone = spark.conf.get("spark.sql.session.timeZone")
    walls = [datetime(2024, 3, 10, 10, 30), datetime(2024, 11, 3, 8, 59, 59, 5), datetime(2024, 11, 3, 9, 30), datetime(1969, 1, 1)]
    df = spark.createDataFrame([(w,) for w in walls], "t timestamp_ntz")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        rows = df.select(utc_wall(utc_instant(F.col("t"))), F.unix_micros(utc_instant(F.col("t")))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r[0] for r in rows] == walls
    assert [r[1] for r in rows] == [round(w.replace(tzinfo=timezone.utc).timestamp() * 1_000_000) for w in walls]
