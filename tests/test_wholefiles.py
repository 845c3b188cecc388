from pyspark.sql import functions as F

from conftest import table
from samplyard.schema import SchemaSpec
from samplyard.sources import screening
from samplyard.sources.wholefiles import whole_files, write_files


def test_the_files_of_sparks_reader(spark, tmp_path):
    folder = tmp_path / "top"
    for name in ("k=1 x/a b%20#?é+&~[].json", "k=ä%/b'\"<>|{}^`;@.json", "k=2/_h.json", "k=2/.h.json", "k=2/e.json", "k=2/none.json", "k=2/f.json._COPYING_", "k=2/t.txt", "k=3/_hid/c.json", "k=3/.hid/d.json", "k=3/in/deep/er/g.json"):
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(b"" if "none" in name else b"\xff\x00{}\r\n")
    for path, pattern in ((folder, "*.json"), (f"{folder}/k=[23]", "{e,g}.js?n"), (folder / "k=2/e.json", "*.json")):
        raw = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(str(path), wholetext=True)
        wanted = raw.select(F.col("_metadata.file_path").alias("file"), F.hex("value"))
        got = whole_files(spark, str(path), pattern).select("file", F.hex("value"))
        assert table(got) == table(wanted) and got.count() > 0


def test_tasks_do_not_grow_with_the_files(spark, tmp_path):
    """Spark's reader deals out a few files a task, whatever their size."""
    schema = SchemaSpec.from_dict({"fields": {"id": {"type": "string", "required": True}}})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for number in range(400):
        (tmp_path / f"{number}.json").write_text(f'{{"id": "{number}"}}')
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
        rows = screening.read_screened_documents(spark, str(tmp_path), schema)
        assert rows.rdd.getNumPartitions() <= 8 and rows.select("id").distinct().count() == 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_written_files(spark, frame, tmp_path):
    rows = frame("n long, t string", [(1, "a"), (2, None), (1, "b"), (None, "é")]).coalesce(1)
    write_files(rows, f"file://{tmp_path}/out", "n", "t")
    found = {str(p.relative_to(tmp_path)): p.read_text() for p in (tmp_path / "out").rglob("*.txt")}
    assert found.pop("out/part-00000/n=1.txt") in ("a\nb\n", "b\na\n")
    assert found == {"out/part-00000/n=2.txt": "\n", "out/part-00000/n=__HIVE_DEFAULT_PARTITION__.txt": "é\n"}
