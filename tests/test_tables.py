import pytest
from conftest import table, values

from samplyard.operators import search, tables

P, S, M = "entity:tube_id", "entity:assay_id", "entity:report_id"


@pytest.fixture
def primary(frame):
    return frame(f"`{P}` string, river string, depth int", [("t9", "Isar", 1), ("t2", "Oder", 5), ("t4", None, 9), ("t1", "Elbe", 3)])


@pytest.fixture
def secondary(frame):
    return frame(f"score int, `{S}` string, lab string", [(55, "t8", "Ulm"), (None, "t1", "Bonn"), (0, None, "Trier"), (70, "t2", "Kiel")])


@pytest.fixture
def master(frame):
    return frame(f"`{M}` string, river string", [(None, "Main"), ("t1", "Elbe"), ("t5", "Lech")])


def test_merge_appends_only_new_rows(primary, secondary, master):
    got = tables.merge_into_master(primary, secondary, master, P, S, M)
    assert got.columns == [M, "river", "depth", "score", "lab"]
    assert table(got) == [("t2", "Oder", 5, 70, "Kiel")]


def test_merge_without_master(primary, secondary):
    assert values(tables.merge_into_master(primary, secondary, None, P, S, M)) == ["t1", "t2"]


def test_merge_with_nothing_in_common_or_all_known(primary, secondary, master, frame):
    strangers = frame(f"`{S}` string, lab string", [("t77", "Jena")])
    assert tables.merge_into_master(primary, strangers, master, P, S, M).count() == 0
    reported = frame(f"`{M}` string", [("t2",), ("t1",), ("t3",)])
    assert tables.merge_into_master(primary, secondary, reported, P, S, M).count() == 0


def test_field_lists(primary, secondary):
    some = tables.merge_tables(primary, secondary, P, S, include=["lab", "depth", "nowhere"], exclude=["depth"])
    assert some.columns == [P, "depth", "lab"]
    less = tables.merge_tables(primary, secondary, P, S, exclude=["score", "river", P])
    assert less.columns == [P, "depth", "lab"]


def test_clashing_columns_are_told_apart(primary):
    got = tables.merge_tables(primary, primary.withColumnRenamed(P, S), P, S)
    assert got.columns == [P, "river_x", "depth_x", "river_y", "depth_y"]


def test_promote(frame):
    source = frame("`entity:an_id` string, value string", [("s1", "a"), ("s2", "b"), ("s3", "c"), (None, "d")])
    some = frame("`entity:x_id` bigint, z string", [(1, "q")]).selectExpr("'s2' AS `entity:x_id`", "z")
    everything = tables.promote(source, None, "entity:an_id", "entity:x_id")
    assert everything.columns == ["entity:x_id", "value"] and values(everything) == ["s1", "s2", "s3"]
    assert values(tables.promote(source, some, "entity:an_id", "entity:x_id")) == ["s1", "s3"]
    assert tables.promote(source, source.withColumnRenamed("entity:an_id", "entity:x_id"), "entity:an_id", "entity:x_id").count() == 0
    assert values(tables.promote(source, some, "entity:an_id", "entity:x_id", lambda df: df.filter("value <> 'a'"))) == ["s3"]
    with pytest.raises(ValueError):
        tables.promote(source, some, "nope", "entity:x_id")


def test_ids_are_compared_as_text(frame):
    left, right = frame("a int", [(1,), (2,), (2,), (None,)]), frame("b string", [("2",), ("3",), (None,)])
    assert values(tables.new_ids(left, right, "a", "b")) == ["1"]
    assert values(tables.common_ids(left, right, "a", "b")) == ["2"]


def test_publish_layout(frame):
    df = frame("a string, sid string, b string", [("1", "s", "2")])
    assert tables.publish_layout(df, "fish_id", "sid").columns == ["entity:fish_id", "a", "b"]
    assert tables.publish_layout(df, "fish", "nope").columns == ["entity:fish_id", "sid", "b"]
    member = tables.set_membership(df, "fish", "set1", "sid")
    assert member.columns == ["membership:fish_set_id", "fish"] and table(member) == [("set1", "s")]


def test_configs_from_template(frame):
    new = tables.new_entity_types(
        frame("entity_type string", [("wgs_1",), ("wgs_2",), ("old",), ("x",), ("wgs_1",)]), frame("entity_type string", [("old",), (None,)]), "wgs"
    )
    assert values(new) == ["wgs_1", "wgs_2"]
    built = tables.configs_from_template(new, {"v": 1, "m": {"k": [1]}}, {"v": 2, "w": "d"}, {"project": "p"}, {"active": False}, ["id", "w"])
    rows = built.collect()
    assert {r["entity_type"] for r in rows} == {"wgs_1", "wgs_2"} and {(r["v"], r["w"], r["m"], r["project"], r["active"], r["transferred"]) for r in rows} == {(1, "d", '{"k": [1]}', "p", False, False)}
    assert len({r["id"] for r in rows}) == 2
    with pytest.raises(ValueError, match="must"):
        tables.configs_from_template(new, required=["must"])


# ---- search --------------------------------------------------------------------------------

@pytest.fixture
def rows(frame):
    return frame("k string, a string, n int", [("1", "Alpha", 10), ("2", "beta", 20), ("3", None, 30), ("4", "alphabet", 1), ("4", "alphabet", 1)])


def found(df):
    return [r["k"] for r in df.orderBy("k").collect()]


def test_terms_are_joined_and_repeats_collapse(rows):
    assert found(search.row_search(rows, ["ALPHA"])) == ["1", "4"]
    assert found(search.row_search(rows, ["alpha", "^2"])) == ["1", "2", "4"]
    assert found(search.row_search(rows, ["a.*t"], ["a", "missing"])) == ["4"]
    assert found(search.row_search(rows, ["alpha"], exact=True)) == []
    assert found(search.row_search(rows, ["1"], exact=True)) == ["1", "4"]
    assert found(search.row_search(rows)) == ["1", "2", "3", "4", "4"]


def test_exclude_keeps_rows_missing_any_term(rows):
    assert found(search.row_search(rows, ["alpha"], exclude=True)) == ["2", "3"]
    assert found(search.row_search(rows, ["alpha", "beta"], exclude=True)) == ["1", "2", "3", "4"]
    assert found(search.row_search(rows, ["none", "nan"], ["a"])) == []


def test_limits_count_per_term(rows):
    assert found(search.row_search(rows, ["alpha", "beta"], max_rows=1, order=["k"])) == ["1", "2"]
    once = search.row_search(rows, ["a"], max_rows=2, randomize=True, order=["k"]).collect()
    assert once == search.row_search(rows, ["a"], max_rows=2, randomize=True, order=["k"]).collect()
    assert search.row_search(rows, max_rows=2).count() == 2
    assert search.row_search(rows, randomize=True).count() == 5


def test_picking(rows, frame):
    assert search.extract_columns(rows, ["n", "zz", "a", "k"]).columns == ["k", "a", "n"]
    ids = frame("k string", [("1",), ("4",)])
    assert found(search.select_ids(rows, ids, "k")) == ["1", "4", "4"]
    assert found(search.select_ids_strict(rows, ids, "k")) == ["1", "4", "4"]
    with pytest.raises(ValueError):
        search.select_ids_strict(rows, frame("k string", [("9",)]), "k")


def test_controls(frame):
    df = frame("s string, flag string", [("NegX", None), ("good", "exclude"), ("fine", None), ("ok", "keep"), (None, None)])
    assert values(search.drop_controls(df, "s", "Ghost|Neg|PC", "flag")) == [None, "fine", "ok"]


@pytest.mark.parametrize("glob, wanted", [("a*", ["a.b", "ab"]), ("a?b", ["a.b"]), ("[!a]*", ["xb"]), ("[ax]b", ["ab", "xb"]), ("*", ["a.b", "ab", "xb"])])
def test_globs(frame, glob, wanted):
    names = frame("entity_type string", [("ab",), ("a.b",), ("xb",), ("ab_set",)])
    assert values(search.glob_tables(names, glob)) == wanted

