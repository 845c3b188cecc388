import json
import os

import pytest
from conftest import at, table, values
from pyspark.sql import functions as F

from samplyard.operators import filejobs, seqfiles, update
from samplyard.plans import ingest
from samplyard.schema import SchemaSpec
from samplyard.sources import configs as config_source
from samplyard.sources import delimited, entities, store

SCHEMA = SchemaSpec.from_yaml("""
fields:
  id: {type: string, primary_key: true, system_value: true}
  sample_id: {type: string, sample_identifier: true}
  state: {type: string}
  read1: {type: string, sequence_file: true}
  count: {type: integer}
  created_at: {type: datetime, system_value: true}
  updated_at: {type: datetime}
""")


# ---- copying -------------------------------------------------------------------------------

@pytest.fixture
def sequences(frame):
    return frame("id string, read1 string, read2 string, other string", [
        ("1", "gs://src/p/a.gz", "gs://src/p/a2.gz", "x"), ("2", "gs://src/p/a.gz", None, "y"), ("3", "gs://dst/in/b.gz", "local", "z"), ("4", "gs://src/q/a.gz", "gs://src/p/none.gz", "w"),
    ])


def test_manifest_is_distinct_and_marks_collisions(sequences):
    got = table(filejobs.copy_manifest(sequences, ["read1", "read2", "absent"], "gs://dst/in"))
    assert got == [
        ("gs://src/p/a.gz", "gs://dst/in/a.gz", True), ("gs://src/p/a2.gz", "gs://dst/in/a2.gz", False),
        ("gs://src/p/none.gz", "gs://dst/in/none.gz", False), ("gs://src/q/a.gz", "gs://dst/in/a.gz", True),
    ]
    kept = filejobs.copy_manifest(sequences, ["read1", "read2"], "gs://dst/in", True)
    assert kept.filter("collides").count() == 0


def test_copy_reports_failures_and_only_successes_are_rewritten(sequences, tmp_path):
    (tmp_path / "src/p").mkdir(parents=True)
    (tmp_path / "src/q").mkdir()
    for name in ("p/a.gz", "p/a2.gz", "q/a.gz"):
        (tmp_path / "src" / name).write_bytes(name.encode() * 1000)
    manifest = filejobs.copy_manifest(sequences, ["read1", "read2"], "gs://dst/in", True)
    mounts = {"gs://src/": str(tmp_path / "src"), "gs://dst/": str(tmp_path / "dst")}
    results = filejobs.copy_files(manifest, mounts)
    assert values(results.filter("success"), "source") == ["gs://src/p/a.gz", "gs://src/p/a2.gz", "gs://src/q/a.gz"]
    assert "FileNotFound" in results.filter("NOT success").first()["error"]
    assert (tmp_path / "dst/in/q/a.gz").read_bytes() == b"q/a.gz" * 1000
    assert not [n for _, _, f in os.walk(tmp_path / "dst") for n in f if n.startswith(".tmp")]
    done = filejobs.rewrite_copied(sequences, ["read1", "read2"], results)
    assert table(done) == [
        ("1", "gs://dst/in/p/a.gz", "gs://dst/in/p/a2.gz", "x"), ("2", "gs://dst/in/p/a.gz", None, "y"),
        ("3", "gs://dst/in/b.gz", "local", "z"), ("4", "gs://dst/in/q/a.gz", "gs://src/p/none.gz", "w"),
    ]


def write_lanes(tmp_path, frame, sizes, known=True):
    rows = []
    for lane, size in enumerate(sizes, 1):
        name = f"s_L{lane:03}_R1.fastq.gz"
        (tmp_path / name).write_bytes(bytes([64 + lane]) * size)
        rows.append(("s", str(lane), name, size if known else None))
    return frame("sample string, file_id string, file_name string, size bigint", rows[::-1])


@pytest.mark.parametrize("block", [7, 10_000])
def test_lanes_are_concatenated_in_order(frame, tmp_path, block):
    files = write_lanes(tmp_path, frame, [100, 33, 0, 250])
    done = filejobs.concatenate(seqfiles.concat_plan(files), str(tmp_path), block=block)
    assert table(done) == [("s_R1.fastq.gz", True, 383, None)]
    assert (tmp_path / "s_R1.fastq.gz").read_bytes() == b"A" * 100 + b"B" * 33 + b"D" * 250
    assert sorted(p.name for p in tmp_path.iterdir()) == ["s_R1.fastq.gz"]


def test_sources_stay_without_known_sizes_or_on_request(frame, tmp_path):
    files = write_lanes(tmp_path, frame, [10, 20], known=False)
    assert filejobs.concatenate(seqfiles.concat_plan(files), str(tmp_path)).first()["success"]
    assert len(list(tmp_path.iterdir())) == 3
    files = write_lanes(tmp_path, frame, [10, 20])
    filejobs.concatenate(seqfiles.concat_plan(files), str(tmp_path), remove_sources=False)
    assert len(list(tmp_path.iterdir())) == 3


def test_wrong_size_or_missing_source_leaves_no_output(frame, tmp_path):
    files = write_lanes(tmp_path, frame, [10, 20]).withColumn("size", F.col("size") + 1)
    bad = filejobs.concatenate(seqfiles.concat_plan(files), str(tmp_path)).first()
    assert not bad["success"] and "size mismatch" in bad["error"]
    (tmp_path / "s_L001_R1.fastq.gz").unlink()
    gone = filejobs.concatenate(seqfiles.concat_plan(files), str(tmp_path)).first()
    assert not gone["success"] and "missing" in gone["error"]
    assert [p.name for p in tmp_path.iterdir()] == ["s_L002_R1.fastq.gz"]


# ---- text and JSON -------------------------------------------------------------------------

def test_missing_value_texts_become_null(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('entity:s_id\ta\tb\n1\tNA\tx\n2\tnan\t"tab\there ""q"""\n3\t\tnull\n4\tna\t1.0\n')
    df = delimited.read_entity_table(spark, str(tmp_path / "t.tsv"))
    assert table(df) == [("1", None, "x"), ("2", None, 'tab\there "q"'), ("3", None, None), ("4", "na", "1.0")]
    assert delimited.read_entity_table(spark, str(tmp_path / "t.tsv"), columns=["b"]).columns == ["entity:s_id", "b"]


def test_written_tables_read_back(spark, frame, tmp_path):
    rows = [("1", 'say "hi"', None), ("2", "a\tb", "x"), ("3", None, "back\\slash")]
    delimited.write_entity_table(frame("`entity:s_id` string, a string, b string", rows), str(tmp_path / "out"))
    assert table(delimited.read_entity_table(spark, str(tmp_path / "out"))) == rows
    with pytest.raises(Exception):
        delimited.write_entity_table(frame("a string", [("1",)]), str(tmp_path / "out"))


def test_upload_kind_follows_the_extension(spark, tmp_path):
    (tmp_path / "one.tsv").write_text("a\tb\n1\tx\n")
    (tmp_path / "two.csv").write_text("a,b\n1,x\n")
    name, df = delimited.read_upload(spark, str(tmp_path / "one.tsv"))
    assert name == "one" and dict(df.dtypes) == {"a": "int", "b": "string"}
    assert delimited.read_upload(spark, str(tmp_path / "two.csv"), "other")[0] == "other"


def test_export_and_sheets(spark, frame, tmp_path):
    df = frame("k string, a string, b string", [("1", "ring", "p"), ("2", "rod", "q"), ("3", "ring", "r")])
    delimited.export_table(df, str(tmp_path / "x"), ["b"], terms=["ring"])
    assert table(delimited.read_entity_table(spark, str(tmp_path / "x"))) == [("1", "p"), ("3", "r")]
    delimited.export_table(df, str(tmp_path / "y"), ["a"], terms=["q"])
    assert table(delimited.read_entity_table(spark, str(tmp_path / "y"))) == [("2", "rod")]
    delimited.write_partitioned_sheet(df, str(tmp_path / "sheets"), ["a"])
    assert sorted(p.name for p in (tmp_path / "sheets").glob("a=*")) == ["a=ring", "a=rod"]


def test_pages_and_metadata(frame):
    meta = frame("value string", [(json.dumps({"sample": {"count": 150, "idName": "sample_id", "attributeNames": ["sample_id", "v1"]}}),)])
    assert table(entities.parse_metadata(meta)) == [("sample", 150, "sample_id", ["sample_id", "v1"])]
    docs = [json.dumps({"results": [{"name": f"e{p}{n}", "attributes": {"v1": n, "sample_id": "no"} if n else {}} for n in range(2)]}) for p in range(2)]
    pages = entities.parse_pages(frame("value string", [(d,) for d in docs]))
    flat = entities.flatten_pages(pages, "sample_id", ["sample_id", "v1", "v2"])
    assert flat.columns == ["entity:sample_id", "v1", "v2"]
    assert table(flat) == [("e00", None, None), ("e01", "1", None), ("e10", None, None), ("e11", "1", None)]
    assert entities.flatten_pages(pages, "sample_id", ["v1", "v2"], ["v2"]).columns == ["entity:sample_id", "v2"]
    assert entities.entity_by_name(flat, "e01").count() == 1


CONFIG = SchemaSpec.from_yaml("""
fields:
  id: {type: string, primary_key: true}
  name: {type: string}
  active: {type: boolean}
  method: {type: json}
  created_at: {type: datetime, system_value: true}
""")


def test_config_directory(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"name": "A", "active": True, "method": {"k": [1, 2]}}, indent=2))
    (tmp_path / "b.json").write_text('{"name": "B", "active": fal')
    (tmp_path / "c.txt").write_text("{}")
    found = config_source.load_config_directory(spark, str(tmp_path), CONFIG)
    row = found.first()
    assert found.count() == 1 and (row["name"], row["active"], json.loads(row["method"])) == ("A", True, {"k": [1, 2]})
    ready = ingest.process_configs(found, CONFIG, "2024-01-01 00:00:00").first()
    assert len(ready["id"]) == 36 and ready["created_at"] == at("2024-01-01")
    good, bad = config_source.split_documents(config_source.read_config_directory(spark, str(tmp_path)))
    assert good.count() == 1 and bad.first()["file"].endswith("b.json")
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad/x.json").write_text("[1")
    with pytest.raises(RuntimeError):
        config_source.load_config_directory(spark, str(tmp_path / "bad"), CONFIG)


# ---- tables --------------------------------------------------------------------------------

def test_table_is_created_once(spark):
    assert store.create_table(spark, "samples_t", SCHEMA, partition_from="created_at")
    assert not store.create_table(spark, "samples_t", SCHEMA)
    with pytest.raises(ValueError):
        store.create_table(spark, "samples_t", SCHEMA, exists_ok=False)
    assert spark.table("samples_t").columns == [*SCHEMA.names, store.PARTITION]
    assert "samples_t" in values(entities.table_names(spark))


def test_load_counts_and_growth(spark, frame, tmp_path):
    path = str(tmp_path / "samples")
    raw = frame("sample_id string, state string, read1 string", [("a", "x", "f"), ("b", "y", ""), ("c", "z", "f")])
    first = store.load_samples(raw, lambda df: ingest.process_samples(df, SCHEMA, as_of="2024-01-01 05:00:00"), path)
    assert first == {"loaded": 2, "filtered": 1}
    more = raw.unionByName(frame("sample_id string, state string, read1 string", [("d", "q", "f")]))
    known = spark.read.parquet(path)
    second = store.load_samples(more, lambda df: ingest.process_samples(df, SCHEMA, known=known, as_of="2024-01-02 05:00:00"), path)
    assert second == {"loaded": 1, "filtered": 3}
    assert values(spark.read.parquet(path), "sample_id") == ["a", "c", "d"]
    empty = store.load_samples(raw.limit(0), lambda df: ingest.process_samples(df, SCHEMA), str(tmp_path / "none"))
    assert empty == {"loaded": 0, "filtered": 0}


def test_update_rewrites_only_touched_days(spark, frame, tmp_path):
    path = str(tmp_path / "samples")
    rows = [(f"i{n}", f"s{n}", "old", None, n, at(f"2024-01-0{1 + n % 3}"), None) for n in range(9)]
    store.append_rows(frame("id string, sample_id string, state string, read1 string, count bigint, created_at timestamp_ntz, updated_at timestamp_ntz", rows), path)
    before = {str(p) for p in (tmp_path / "samples").rglob("*.parquet")}
    records = frame("id string, position bigint, changes map<string,string>", [("i0", 0, {"state": "new"}), ("i3", 1, {"state": "new"}), ("zz", 2, {"state": "new"})])
    store.rewrite_touched(spark, path, records, lambda t: update.apply_records(t, records, SCHEMA, "2024-02-02 00:00:00", fields=["state"]))
    after = {str(p) for p in (tmp_path / "samples").rglob("*.parquet")}
    assert {p.split("created_date=")[1][:10] for p in before & after} == {"2024-01-02", "2024-01-03"}
    spark.catalog.refreshByPath(path)
    got = {r["id"]: r["state"] for r in spark.read.parquet(path).collect()}
    assert got == {f"i{n}": "new" if n in (0, 3) else "old" for n in range(9)}


def test_literal_rows_take_the_declared_types(spark, tmp_path):
    store.insert_rows(spark, [{"id": "1", "count": 3, "created_at": "2024-01-01 00:00:00"}, {"id": "2", "count": "x"}], SCHEMA, str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert dict(df.dtypes)["count"] == "bigint" and table(df.select("id", "count")) == [("1", 3), ("2", None)]


def test_ingest_publish_and_mark_round(spark, frame, tmp_path):
    """Load all configs, store, publish from the stored table, mark, and find nothing left to do."""
    schema = SchemaSpec.from_yaml("""
fields:
  id: {type: string, primary_key: true, system_value: true}
  sample_id: {type: string, sample_identifier: true}
  config_id: {type: string, inherit_from_config: id, configuration_identifier: true}
  read1: {type: string, sequence_file: true}
  created_at: {type: datetime, system_value: true}
  updated_at: {type: datetime}
  uploaded_at: {type: datetime}
  submitted_at: {type: datetime}
  upload_source: {type: string}
  submission_id: {type: string}
  workflow_state: {type: string}
""")
    now = "2024-03-04 05:06:07"
    samples = spark.createDataFrame([], schema.struct)
    configs = frame("id string, prefix string", [("c1", "lab"), ("c2", "ward"), ("c3", "none")])
    raw = frame("sample_id string, read1 string, cfg string", [("a", "f", "c1"), ("b", "f", "c1"), ("c", "", "c2"), ("d", "f", "cX")])
    run = ingest.ingest_all(raw, configs, samples, schema, "cfg", "prefix", as_of=now)
    assert table(run["results"].drop("set_name")) == [
        ("c1", "success", 2, 0, 2), ("c2", "no_new_samples", 0, 1, 0), ("c3", "no_data", 0, 0, 0)
    ]
    assert table(ingest.run_counts(run["results"])) == [("no_data", 1, 0, 0), ("no_new_samples", 1, 0, 0), ("success", 1, 2, 2)]
    path = str(tmp_path / "samples")
    store.append_rows(run["rows"], path)
    stored = spark.read.parquet(path).drop(store.PARTITION)
    published = ingest.upload_sets(ingest.waiting_for_upload(stored, "today", now), configs, "prefix", now)
    assert table(published.select("sample_id", "set_name")) == [("a", "lab_20240304_050607"), ("b", "lab_20240304_050607")]
    marked = ingest.mark_sets_uploaded(stored, published, now)
    assert ingest.waiting_for_upload(marked, "today", now).count() == 0
    given = frame("config_id string, set_name string, submission_id string", [("c1", "lab_20240304_050607", "sub9")])
    flow = ingest.single_table_flow(marked, given, "sample_id", "today", now)
    assert table(flow["sets"]) == [("c1", "lab_20240304_050607", 2)]
    assert set(values(flow["samples"], "submission_id")) == {"sub9"} and set(values(flow["samples"], "workflow_state")) == {"Submitted"}


def test_rows_without_a_creation_day_are_updated_too(spark, frame, tmp_path):
    path = str(tmp_path / "samples")
    rows = [("a", "old", at("2024-01-01")), ("b", "old", None), ("c", "old", None)]
    store.append_rows(frame("id string, state string, created_at timestamp_ntz", rows), path)
    records = frame("id string, position bigint, changes map<string,string>", [("a", 0, {"state": "new"}), ("b", 1, {"state": "new"})])
    store.rewrite_touched(spark, path, records, lambda t: update.apply_records(t, records, SCHEMA, "2024-02-02 00:00:00", fields=["state"]))
    spark.catalog.refreshByPath(path)
    assert table(spark.read.parquet(path).select("id", "state")) == [("a", "new"), ("b", "new"), ("c", "old")]


def test_literal_rows_are_seen_in_a_partitioned_table(spark, frame, tmp_path):
    path = str(tmp_path / "samples")
    store.append_rows(spark.createDataFrame([], SCHEMA.struct).unionByName(frame("id string, created_at timestamp_ntz", [("a", at("2024-01-01"))]), allowMissingColumns=True), path)
    store.insert_rows(spark, [{"id": "b", "created_at": "2024-01-02 00:00:00"}, {"id": "c"}], SCHEMA, path)
    assert values(spark.read.parquet(path), "id") == ["a", "b", "c"]


def test_nested_fields_keep_their_types(spark, tmp_path):
    schema = SchemaSpec.from_yaml("""
fields:
  id: {type: string}
  tags: {type: array, items: {type: string}}
  place: {type: record, fields: {row: {type: integer}}}
""")
    store.insert_rows(spark, [{"id": "1", "tags": ["x", "y"], "place": {"row": 3}}, {"id": "2"}], schema, str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert dict(df.dtypes) == {"id": "string", "tags": "array<string>", "place": "struct<row:bigint>"}
    assert [(r["tags"], r["place"] and r["place"]["row"]) for r in df.orderBy("id").collect()] == [(["x", "y"], 3), (None, None)]


def test_copies_run_once_however_often_the_results_are_read(frame, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src/a").write_bytes(b"first")
    rows = frame("x string, y string", [("gs://src/a", "gs://src/a")])
    mounts = {"gs://src/": str(tmp_path / "src"), "gs://dst/": str(tmp_path / "dst")}
    results = filejobs.copy_files(filejobs.copy_manifest(rows, ["x", "y"], "gs://dst"), mounts)
    (tmp_path / "src/a").write_bytes(b"second")
    done = filejobs.rewrite_copied(rows, ["x", "y"], results)
    assert table(done) == [("gs://dst/a", "gs://dst/a")]
    assert (tmp_path / "dst/a").read_bytes() == b"first"


def test_stored_update_reports_every_record(spark, frame, tmp_path):
    schema = SchemaSpec.from_yaml("""
fields:
  id: {type: string, primary_key: true}
  lab: {type: string}
  created_at: {type: datetime}
  updated_at: {type: datetime}
""")
    path, day = str(tmp_path / "t"), at("2024-03-04T05:06:07")
    ddl = "id string, lab string, created_at timestamp_ntz, updated_at timestamp_ntz"
    store.append_rows(frame(ddl, [("a", "x", day, None), ("b", "x", None, None), ("c", "x", at("2024-04-01"), None)]), path)
    ups = frame("id string, position bigint, changes map<string,string>", [
        ("a", 0, {"lab": "one", "created_at": "2030-01-01"}), ("a", 1, {"lab": "two"}), ("b", 2, {"lab": "three"}),
        ("zz", 3, {"lab": "lost"}), (None, 4, {"lab": "lost"}), ("c", 5, {"lab": None}),
    ])
    counts = store.update_rows(spark, path, ups, schema, "2024-05-06 00:00:00")
    got = {r["id"]: (r["lab"], r["created_at"]) for r in spark.read.parquet(path).collect()}
    assert got == {"a": ("one", day), "b": ("three", None), "c": ("x", at("2024-04-01"))}
    assert table(counts.select("applied", "unmatched", "rejected")) == [(3, 1, 2)]
    assert update.accounting(frame(ddl, []), ups, schema).first()["applied"] == 0


def test_configs_without_required_fields_are_refused(spark, frame, tmp_path):
    schema = SchemaSpec.from_yaml("""
fields:
  id: {type: string, required: true, primary_key: true}
  lab: {type: string, required: true}
  settings: {type: JSON}
""")
    path = str(tmp_path / "configs")
    df = frame("id string, lab string, settings map<string,int>", [("c1", "Kiel", {"k": 1}), (None, "Ulm", None), ("c3", None, None)])
    assert ingest.load_configs(df, schema, path) == {"loaded": 2, "filtered": 1}
    assert ingest.load_configs(df.limit(0), schema, path) == {"loaded": 0, "filtered": 0}
    assert values(spark.read.parquet(path), "lab") == ["Kiel", "Ulm"]


def test_an_empty_publish_is_refused(spark, frame, tmp_path):
    df = frame("`entity:w_id` string, lab string", [("A1", "Kiel"), ("A2", None)])
    with pytest.raises(ValueError, match="nothing to publish"):
        delimited.publish_entity_table(df.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    delimited.publish_entity_table(df, str(tmp_path / "some"))
    assert table(delimited.read_entity_table(spark, str(tmp_path / "some"))) == [("A1", "Kiel"), ("A2", None)]
