import pytest
from conftest import at, table, values
from pyspark.sql import functions as F

from samplyard.functions import names, paths
from samplyard.operators import seqfiles
from samplyard.plans import fetch
from samplyard.sources import datasets as source

DS = "dataset_id string, name string, date_created timestamp_ntz"
FILES = "dataset_id string, file_id string, file_name string, size bigint, is_paired_end boolean"


def one(spark, text, fn):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t"))).first()[0]


def test_read_side(spark, frame):
    sided = [(f"pond{sep}{mark}{n}{tail}", f"R{n}") for sep in "_-" for mark in "rR" for n in (1, 2) for tail in (".fastq.gz", "_x.FastQ.gz")]
    plain = [(name, None) for name in ("pond_I2.fastq.gz", "pondR2.fastq.gz", "pond_R1.fastq", "pond_R1.bam", "", "pond_R3.fastq.gz")]
    both = [("pond_R2_R1.fastq.gz", "R1")]
    df = frame("name string, side string", sided + plain + both)
    assert df.filter(~names.read_side(F.col("name")).eqNullSafe(F.col("side"))).count() == 0


def test_lane_strip(spark, frame):
    lanes, tails = ("_L3", "-l12", "_L004"), ("", "_R1.fastq.gz", "-r2_part.fq")
    rows = [(stem + lane + tail, stem + tail) for stem in ("pond", "W-7", "a_b") for lane in lanes for tail in tails]
    rows += [(name, name) for name in ("pond_L0004", "pondL4", "pond_L4_tail", "pond_Lx_R1.fq", "")]
    rows += [("pond_L5_L6", "pond_L5"), ("pond_L5_R2_L6_R1.fq", "pond_R2_L6_R1.fq")]  # one token goes, where a read or the end follows
    df = frame("name string, bare string", rows)
    assert df.filter(names.strip_lane(F.col("name")) != F.col("bare")).count() == 0


def match(frame, sample, rows, **options):
    got = seqfiles.match_datasets(frame("sample string", [(sample,)]), frame(DS, rows), **options)
    found = table(got.select("status", "dataset_id"))
    assert len({status for status, _ in found}) == 1
    return found[0][0], [i for _, i in found if i]


LANES = [(f"lane{n}", f"pond-9_L{n}", at("2023-03-01")) for n in (8, 2, 5)]


def test_lane_siblings_need_permission(frame):
    assert match(frame, "pond-9", LANES) == ("partial", [])
    assert match(frame, "\tpond-9", LANES, group_by_lane=True) == ("lanes", ["lane2", "lane5", "lane8"])
    assert match(frame, "lake", LANES, group_by_lane=True) == ("missing", [])


def test_exact_name_beats_siblings(frame):
    rows = [("whole", "pond-9", at("2019-07-07")), *LANES]
    assert match(frame, "pond-9", rows, group_by_lane=True) == ("exact", ["whole"])
    assert match(frame, "pond-9_L5", rows) == ("exact", ["lane5"])


def test_repeats_and_ties(frame):
    spring, summer = at("2023-04-02T08:00"), at("2023-07-30T17:45")
    twice = [("p2", "pond", summer), ("p1", "pond", spring)]
    assert match(frame, "pond", twice) == ("duplicate", [])
    assert match(frame, "pond", twice, use_latest=True) == ("exact", ["p2"])
    assert match(frame, "pond", [*twice, ("p3", "pond", summer)], use_latest=True) == ("tie", [])
    lanes = [("e1", "lake_L1", summer), ("e0", "lake_L1", spring), ("e2", "lake_L2", spring)]
    assert match(frame, "lake", lanes, group_by_lane=True) == ("duplicate", [])
    assert match(frame, "lake", lanes, group_by_lane=True, use_latest=True) == ("lanes", ["e1", "e2"])


def test_one_dataset_can_serve_two_requests(frame):
    got = seqfiles.match_datasets(frame("sample string", [("s",), ("s_L001",), ("s",)]), frame(DS, [("a", "s_L001", at("2026-01-01"))]), group_by_lane=True)
    assert table(got.select("sample", "status", "dataset_id")) == [("s", "lanes", "a"), ("s_L001", "exact", "a")]


def test_newest_per_name(frame):
    rows = [("a", "x", at("2026-01-01")), ("b", "x", at("2026-01-02")), ("c", "y", at("2026-01-01")), ("d", "y", at("2026-01-01"))]
    got = table(seqfiles.latest_per_name(frame(DS, rows), ["name"]).select("name", "dataset_id", "copies", "tie"))
    assert got == [("x", "b", 2, False), ("y", "c", 2, True)]
    assert values(seqfiles.duplicate_names(frame(DS, rows))) == ["x", "y"]


def test_dataset_types(frame):
    df = frame("n int, type_id string, conforms_to array<string>", [(1, "common.fastq", []), (2, "v.fastq", ["common.fastq"]), (3, "bam", None), (4, None, None)])
    pick = lambda types: values(df.filter(seqfiles.of_type(types)), "n")
    assert pick(None) == [1, 2, 3, 4] and pick([]) == [] and pick(["common.fastq"]) == [1, 2] and pick(["bam", "x"]) == [3]


@pytest.mark.parametrize("names_, paired, wanted", [
    (["a_R1.fastq.gz", "a_R2.fastq.gz"], True, "ok"),
    (["a_R1.fastq.gz"], True, "unbalanced"),
    (["a_R1.fastq.gz", "b_R1.fastq.gz"], True, "unbalanced"),
    (["a_R1.fastq.gz", "a_R2.fastq.gz", "a_I1.fastq.gz"], True, "unbalanced"),
    (["a_R1.fastq.gz", "a_R2.fastq.gz"], None, "not_paired"),
])
def test_pairs(frame, names_, paired, wanted):
    files = frame(FILES, [("d", str(i), n, 1, paired) for i, n in enumerate(names_)])
    assert seqfiles.paired_check(files, ["dataset_id"]).first()["status"] == wanted


def test_sheet(frame):
    datasets = frame("dataset_id string, name string, type_id string, is_paired_end boolean", [("d", "x", "common.fastq", True), ("e", "y", None, None)])
    files = frame(FILES, [("d", "1", "a_L1_R1.fastq.gz", 1_048_576, True), ("d", "2", "a_L1_R2.fastq.gz", 2_097_152, True), ("d", "3", "a_L2_R2.fastq.gz", None, True)])
    rows = table(seqfiles.dataset_sheet(datasets, files))
    assert rows == [("x", "d", "1.05 MB", "2.10 MB", 3, "common.fastq", True, False), ("y", "e", "0.00 MB", "0.00 MB", 0, "", False, False)]


@pytest.mark.parametrize("size", [0, 5_000, 15_000, 605_000, 1_005_000, 2_675_000, 1_048_576, 99_995_000])
def test_sizes_round_like_the_printed_float(spark, size):
    got = spark.createDataFrame([(size,)], "s bigint").select(names.megabyte_text(F.col("s"))).first()[0]
    assert got.replace(",", "") == f"{size / 1_000_000:.2f} MB"


def test_lane_names_and_sizes(frame):
    files = frame("sample string, file_name string, size bigint", [("s", "s_L001_R1_001.fastq.gz", 1), ("s", "s_L002_R1_001.fastq.gz", 2), ("t", "t_L001_R1_001.fastq.gz", 1), ("t", "t_L001_R1_002.fastq.gz", None)])
    assert table(seqfiles.lane_naming_check(seqfiles.files_by_read(files), ["sample", "read"])) == [("t", "R1", 2)]
    assert table(seqfiles.expected_size(files, ["sample"])) == [("s", 3, 2), ("t", None, 2)]


def test_concat_plan_orders_by_name(frame):
    files = frame("sample string, file_id string, file_name string, size bigint", [
        ("s", "3", "s_L003_R1.fastq.gz", 5), ("s", "1", "s_L001_R1.fastq.gz", 7), ("s", "2", "s_L002_R1.fastq.gz", 11),
        ("s", "4", "s_L001_R2.fastq.gz", 1), ("s", "5", "notes.txt", 1),
    ])
    got = table(seqfiles.concat_plan(files).select("output_name", "position", "file_name", "offset"))
    assert got == [
        ("s_R1.fastq.gz", 1, "s_L001_R1.fastq.gz", 0), ("s_R1.fastq.gz", 2, "s_L002_R1.fastq.gz", 7),
        ("s_R1.fastq.gz", 3, "s_L003_R1.fastq.gz", 18), ("s_R2.fastq.gz", 1, "s_L001_R2.fastq.gz", 0),
    ]


ITEMS = [
    '{"Type":"Run","Run":{"Id":"1","Name":"r","ExperimentName":"exp"},"Score":1}',
    '{"Type":"project","Project":{"Id":"2","Name":"exp"}}',
    '{"Type":"Run","Project":{"Id":"3"}}',
    '{"Type":"biosample","BioSample":{"Id":"4"}}',
    '{"Type":"PROJECT","Project":{"Id":"5","Name":"only"}}',
]


def test_search_items(frame):
    items = source.parse_search_items(frame("value string", [(t,) for t in ITEMS]))
    assert values(items, "type") == ["other", "other", "project", "project", "run"]
    assert items.filter("type = 'other'").filter("raw IS NULL").count() == 0
    assert table(source.collection_items(items)) == [("projects", "exp", "2"), ("projects", "only", "5"), ("runs", "exp", "1")]


def test_name_resolution(frame):
    items = frame("scope string, name string, item_id string", [("runs", "a", "1"), ("projects", "a", "2"), ("runs", "b", "3"), ("runs", "b", "4"), ("projects", "c", "5"), ("runs", "c ", "6")])
    asked = frame("name string", [(" a",), ("b",), ("c",), ("d",), ("a",)])
    rows = lambda priority: table(seqfiles.resolve_names(asked, items, priority))
    assert rows(None) == [("a", "ambiguous_scope", None, None), ("b", "duplicate", None, None), ("c", "resolved", "projects", "5"), ("d", "missing", None, None)]
    assert rows("runs")[0] == ("a", "resolved", "runs", "1") and rows("projects")[0] == ("a", "resolved", "projects", "2")
    assert rows("runs")[2] == ("c", "resolved", "projects", "5") and rows("projects")[1][1] == "duplicate"


def test_datasets_and_pages(frame):
    text = '{"Id":"d1","Name":"n","DateCreated":"2026-08-10T01:02:03.1234567Z","DatasetType":{"Id":"t"},"Attributes":{"common_fastq":{"IsPairedEnd":true,"TotalClustersPF":7}},"More":1}'
    row = source.parse_datasets(frame("value string", [(text,)])).first()
    assert (row["dataset_id"], row["date_created"], row["conforms_to"], row["is_paired_end"], row["total_clusters_pf"]) == ("d1", at("2026-08-10T01:02:03.123456"), [], True, 7)
    page = '{"Items":[{"Id":"f1","Name":"a","Size":3},{"Id":"f2","Name":"b"}],"Paging":{"Offset":0,"Limit":2,"DisplayedCount":2,"TotalCount":2}}'
    files = source.flatten_files(source.parse_page(frame("dataset_id string, value string", [("d1", page)]), source.FILE))
    assert table(files) == [("d1", "f1", "a", 3), ("d1", "f2", "b", None)]


def test_fetch_plan(frame):
    asked = frame("collection string, sample string", [("exp", "s "), ("exp", "lone"), ("exp", "twice"), ("exp", "twice"), ("nowhere", "s"), ("exp", "gone"), ("exp", "bam")])
    items = frame("scope string, name string, item_id string", [("runs", "exp", "1")])
    day = at("2026-01-01")
    datasets = frame("item_id string, dataset_id string, name string, date_created timestamp_ntz, type_id string, conforms_to array<string>, is_paired_end boolean", [
        ("1", "a", "s_L001", day, "common.fastq", [], True), ("1", "b", "s_L002", day, "v", ["common.fastq"], True),
        ("1", "c", "lone", day, "common.fastq", [], True), ("1", "d", "bam", day, "bam", [], True), ("2", "e", "gone", day, "common.fastq", [], True),
    ])
    files = frame("item_id string, dataset_id string, file_id string, file_name string, size bigint", [
        ("1", "a", "1", "s_L001_R1.fastq.gz", 3), ("1", "a", "2", "s_L001_R2.fastq.gz", 4),
        ("1", "b", "3", "s_L002_R1.fastq.gz", 5), ("1", "b", "4", "s_L002_R2.fastq.gz", 6), ("1", "c", "5", "lone_R1.fastq.gz", 1),
    ])
    done = fetch.fetch_plan(asked, items, datasets, files, group_by_lane=True)
    assert table(done["results"].select("collection", "sample", "status", "files", "r1_bytes")) == [
        ("exp", "bam", "missing", 0, 0), ("exp", "gone", "missing", 0, 0), ("exp", "lone", "unbalanced", 1, 1),
        ("exp", "s", "ok", 4, 8), ("exp", "twice", "requested_twice", 0, 0), ("nowhere", "s", "collection_missing", 0, 0),
    ]
    assert values(done["files"], "file_id") == ["1", "2", "3", "4"]
    loose = fetch.fetch_plan(asked, items, datasets, files, None, group_by_lane=True, validate_paired=False)
    assert dict((r["sample"], r["status"]) for r in loose["results"].filter("collection = 'exp'").collect())["lone"] == "ok"


def test_fetch_plan_in_rounds(spark, frame, monkeypatch):
    """Collections are planned in parts, which are staged: nothing is left to shuffle for the results."""
    n = 40
    asked = [(f"c{i % 9}", f"s{i}") for i in range(n)] + [("c1", "s1"), ("gone", "s2"), (None, "s3"), ("c4", None)]
    items = [("runs", f"c{i}", str(i // 2)) for i in range(8)] + [("runs", "c7", "x")]
    datasets = [(str((i % 9) // 2), f"d{i}", f"s{i}" + "_L001" * (i % 2), at("2026-01-01"), "common.fastq", [], i % 5 > 0) for i in range(n)]
    files = [(d[0], d[1], f"{d[1]}-{r}", f"{d[2]}_{r}.fastq.gz", 3) for i, d in enumerate(datasets) for r in ("R1", "R2")[: 2 - (i % 7 == 0)]]
    inputs = (
        frame("collection string, sample string", asked), frame("scope string, name string, item_id string", items),
        frame("item_id string, dataset_id string, name string, date_created timestamp_ntz, type_id string, conforms_to array<string>, is_paired_end boolean", datasets),
        frame("item_id string, dataset_id string, file_id string, file_name string, size bigint", files),
    )
    plans = []
    for rounds in (1, 3):
        monkeypatch.setattr(fetch, "rounds_of", lambda *frames, most: rounds, raising=False)  # noqa: B023
        plans.append(fetch.fetch_plan(*inputs, group_by_lane=True, validate_lanes=True))
    whole, parts = plans
    assert "Exchange" not in parts["results"]._jdf.queryExecution().executedPlan().toString()
    assert table(parts["results"]) == table(whole["results"]) and table(parts["files"].select(sorted(parts["files"].columns))) == table(whole["files"].select(sorted(whole["files"].columns)))
    assert len({r["status"] for r in parts["results"].collect()}) > 4 and parts["files"].count() > 0


# ---- paths ---------------------------------------------------------------------------------

def test_path_split(spark):
    for bucket, key in (("vault", ""), ("vault", "w7.fq"), ("vault-2", "in/2024/w 7.fq")):
        path = f"gs://{bucket}/{key}" if key else f"gs://{bucket}"
        assert (one(spark, path, paths.bucket_of), one(spark, path, paths.key_of)) == (bucket, key)
    for path in ("in/w7.fq", "", None):
        assert (one(spark, path, paths.bucket_of), one(spark, path, paths.key_of)) == (None, None)


@pytest.mark.parametrize("path, target, keep, wanted", [
    ("gs://src/a/b/f.gz", "dest", False, "gs://dest/f.gz"),
    ("gs://src/a/b/f.gz", "dest", True, "gs://dest/a/b/f.gz"),
    ("gs://src/a/b/f.gz", "gs://dest/in", False, "gs://dest/in/f.gz"),
    ("gs://src/a/b/f.gz", "gs://dest/in/deep", True, "gs://dest/in/deep/a/b/f.gz"),
    ("gs://dest/a/f.gz", "gs://dest/in", False, "gs://dest/a/f.gz"),
    ("/local/f.gz", "dest", False, "/local/f.gz"), ("", "dest", False, ""), (None, "dest", False, None),
])
def test_destinations(spark, path, target, keep, wanted):
    assert one(spark, path, lambda c: paths.destination_path(c, target, keep)) == wanted


def test_names(spark):
    assert one(spark, "/a/b/table.v1.tsv", names.file_stem) == "table.v1"
    assert one(spark, ".hidden", names.file_stem) == ".hidden"
    assert one(spark, "My run: #3 (é)", names.safe_name) == "My_run_3_é_"
    assert one(spark, "a_set_set", lambda c: names.without_suffix(c, "_set")) == "a_set"
    assert names.entity_id_column("fish_id") == names.entity_id_column("fish") == "entity:fish_id"
    moment = F.lit("2024-07-01 03:04:05").cast("timestamp_ntz")
    assert one(spark, "p", lambda c: names.set_name(c, moment, "America/New_York")) == "p_20240630_230405"


def test_target_entity(spark):
    from samplyard.functions.jsontext import target_entity

    assert one(spark, '{"entityType":"a_set_b_set"}', target_entity) == "a_set_b"
    assert one(spark, "{bad", target_entity) is None
