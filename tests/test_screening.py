import pytest
from conftest import table

from samplyard.schema import SchemaSpec
from samplyard.sources import screening as s

SCHEMA = SchemaSpec.from_yaml("""
fields:
  id: {type: string, required: true, primary_key: true}
  name: {type: string, required: true}
  size: {type: integer}
  nested: {type: json}
""")


def land(folder, **files):
    for name, text in files.items():
        (folder / f"{name}").write_text(text)
    return str(folder)


def marks(df, *names):
    return table(df.select(*names, s.REASON))


def test_ragged_lines(spark, tmp_path):
    path = land(tmp_path, a="entity:id\tx\ty\n1\ta\tb\n2\ta\n3\ta\tb\tc\n\t\tb\nNA\ta\tb\n\n", b='entity:id\tx\ty\n4\t"a\tb"\tc\n5\t"a\tb"\n6\tn/a\t\n')
    rows = s.read_screened_table(spark, path)
    assert rows.columns == ["entity:id", "x", "y", s.FILE, s.TEXT, s.REASON]
    assert table(rows.select("`entity:id`", "x", "y", s.TEXT, s.REASON)) == sorted([
        ("1", "a", "b", None, None), ("4", "a\tb", "c", None, None), ("6", None, None, None, None),
        (None, None, None, "2\ta", s.TOO_FEW), (None, None, None, "3\ta\tb\tc", s.TOO_MANY), (None, None, None, '5\t"a\tb"', s.TOO_FEW),
        (None, None, "b", None, s.NO_ID), (None, "a", "b", None, s.NO_ID),
    ], key=lambda r: [str(x) for x in r])
    assert {r[0].rsplit("/", 1)[1] for r in rows.select(s.FILE).collect()} == {"a", "b"}


def test_pruned_columns_do_not_hide_ragged_lines(spark, tmp_path):
    path = land(tmp_path, a="id,x,y\n1,a,b\n2,a\n")
    rows = s.read_screened_table(spark, path, separator=",")
    assert table(rows.select("id")) == [("1",), (None,)]
    assert rows.filter(f"{s.REASON} IS NULL").select("x").count() == 1


def test_files_without_a_header(spark, tmp_path):
    rows = s.read_screened_table(spark, land(tmp_path, a="1\ta\n2\n"), ["id", "x"])
    assert marks(rows, "id") == [("1", None), (None, s.TOO_FEW)]


def test_load_splits_and_counts_in_one_pass(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    read = s.load_table(spark, land(source, a="id\tx\n1\ta\n2\n3\tc\n\tz\n"), str(tmp_path / "out"))
    assert read.counts == {"good": 2, s.TOO_FEW: 1, s.TOO_MANY: 0, s.NO_ID: 1}
    assert read.good.columns == ["id", "x", s.FILE] and table(read.good.select("id", "x")) == [("1", "a"), ("3", "c")]
    assert marks(read.refused, "id", "x", s.TEXT) == [(None, None, "2", s.TOO_FEW), (None, "z", None, s.NO_ID)]
    plan = read.good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(refused" in plan
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        s.load_table(spark, str(source), str(tmp_path / "out"))


def test_all_bad_is_an_error_that_leaves_the_rows(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    with pytest.raises(ValueError, match="nothing of 2 rows"):
        s.load_table(spark, land(source, a="id\tx\n1\n2\n"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    empty = tmp_path / "none"
    empty.mkdir()
    read = s.load_table(spark, land(empty, a="id\tx\n"), str(tmp_path / "out2"))
    assert read.counts["good"] == 0 and read.good.count() == read.refused.count() == 0


def test_documents(spark, tmp_path):
    path = land(
        tmp_path,
        **{
            "a.json": '{"id": "1", "name": "n", "size": "7", "nested": {"k": [1]}, "extra": 1}', "b.json": '{"id": "2", "name"', "c.json": "[1]",
            "d.json": " \n ", "e.json": '{"id": "3", "name": ""}', "f.json": '"text"', "g.json": '{"name": "n", "size": "x"}', "h.txt": "{", "i.json": "{}",
        },
    )
    rows = s.read_screened_documents(spark, path, SCHEMA)
    got = {r[s.FILE].rsplit("/", 1)[1]: r for r in rows.collect()}
    reasons = {f: r[s.REASON] for f, r in got.items()}
    assert reasons == {
        "a.json": None, "b.json": s.NOT_JSON, "c.json": s.NOT_OBJECT, "d.json": s.EMPTY, "e.json": "without name", "f.json": s.NOT_OBJECT,
        "g.json": "without id", "i.json": "without id",
    }
    good = got["a.json"]
    assert (good["id"], good["name"], good["size"], good["nested"], good[s.TEXT]) == ("1", "n", 7, '{"k":[1]}', None)
    assert got["b.json"][s.TEXT] == '{"id": "2", "name"' and got["e.json"][s.TEXT] == '{"id": "3", "name": ""}'


def test_load_documents(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    read = s.load_documents(spark, land(source, **{"a.json": '{"id": "1", "name": "n"}', "b.json": "{"}), str(tmp_path / "out"), SCHEMA)
    assert {k: n for k, n in read.counts.items() if n} == {"good": 1, s.NOT_JSON: 1}
    assert read.good.select(*SCHEMA.names).collect() == [("1", "n", None, None)]
    other = tmp_path / "bad"
    other.mkdir()
    with pytest.raises(ValueError, match="nothing of 1 rows"):
        s.load_documents(spark, land(other, **{"b.json": "{"}), str(tmp_path / "out2"), SCHEMA)


def test_unlisted_reasons_are_refused(spark, frame, tmp_path):
    rows = frame(f"id string, {s.TEXT} string, {s.REASON} string", [("1", None, None), ("2", "x", "odd")])
    with pytest.raises(ValueError, match="other than"):
        s.load_screened(rows, str(tmp_path / "out"), ["even"])
