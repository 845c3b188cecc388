"""Very many small files, each one text: written and read inside tasks.

Spark's readers keep an entry of every file on the driver and count each as some MB when they deal them out,
its writers make a folder, a checksum and a rename for each. Here tasks list folders, deal the names out and
read whole files, so neither the driver nor the number of tasks grows with the files.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplyard.functions.columns import col
from samplyard.session import glob_paths

#: Bytes of text, and rows, that go back to Spark at once.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 10_000
#: Folders below the path whose names are dealt out over the tasks; deeper ones are walked by the task that has them.
LEVELS = 2
NO_NAME = "__HIVE_DEFAULT_PARTITION__"
#: What a URI has to quote.
QUOTED = re.compile(r"[\x00-\x20\"#%<>?\[\\\]^`{|}\x7f-\xa0]")

ENTRY = "root string, name string, is_file boolean"


def _open_root(root: str):
    from pyarrow import fs

    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root[5:].lstrip("/")
    return fs.FileSystem.from_uri(root)


def _is_hidden(name: str) -> bool:
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _inside(files, base: str, name: str, matches) -> Iterator[tuple[str, bool]]:
    """Entries of a folder, and whether they are files; hidden, empty and other files are left out, as Spark's readers do."""
    from pyarrow import fs

    for found in files.get_file_info(fs.FileSelector(base + name)):
        if not _is_hidden(found.base_name) and (found.type == fs.FileType.Directory or (found.size and matches(found.base_name))):
            yield f"{name}/{found.base_name}", found.type != fs.FileType.Directory


def whole_files(spark: SparkSession, path: str, pattern: str, file: str = "file") -> DataFrame:
    """(``file``, ``value``): the address and the whole text of every file below ``path`` whose name fits ``pattern``.

    Addresses, bytes and the files left out are those of Spark's ``text`` reader with ``wholetext``, which also
    reads the stores that Arrow does not know.
    """
    roots = glob_paths(spark, path)
    if not roots or not all(map(_is_reachable, roots)):
        raw = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True)
        return raw.select(F.col("_metadata.file_path").alias(file), "value")
    regex = spark._jvm.org.apache.hadoop.fs.GlobPattern.compile(pattern).pattern()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = re.compile(regex, re.DOTALL).fullmatch
        for batch in batches:
            for root, name, is_file in zip(*(c.to_pylist() for c in batch.columns)):
                files, base = _open_root(root)
                rows = [(name, True)] if is_file else [*_inside(files, base, name, matches)]
                for start in range(0, len(rows), BATCH_ROWS):
                    names, kinds = zip(*rows[start : start + BATCH_ROWS])
                    yield pa.RecordBatch.from_pydict({"root": [root] * len(names), "name": list(names), "is_file": list(kinds)})

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        matches = re.compile(regex, re.DOTALL).fullmatch
        for batch in batches:
            for root, name, is_file in zip(*(c.to_pylist() for c in batch.columns)):
                files, base = _open_root(root)
                todo = [(name, is_file)]
                while todo:
                    name, is_file = todo.pop()
                    if is_file:
                        with files.open_input_stream(base + name) as stream:  # unpacked by the ending of its name
                            yield QUOTED.sub(lambda m: quote(m[0]), root + name), stream.read()
                    else:
                        todo += _inside(files, base, name, matches)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, values, held = [], [], 0
        for name, value in texts(batches):
            names.append(name)
            values.append(value)
            held += len(value)
            if held >= BATCH_BYTES or len(names) >= BATCH_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.binary())], [file, "value"])
                names, values, held = [], [], 0
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.binary())], [file, "value"])

    entries = spark.createDataFrame([(root, "", not _is_folder(root)) for root in roots], ENTRY)
    for _ in range(LEVELS):
        entries = entries.mapInArrow(expand, ENTRY).repartition(tasks, "root", "name")
    return entries.mapInArrow(read, f"`{file}` string, value binary").select(col(file), col("value").cast("string").alias("value"))


def _is_reachable(root: str) -> bool:
    """Whether Arrow finds what Hadoop's file system has there."""
    from pyarrow import fs

    try:
        files, base = _open_root(root)
        return files.get_file_info(base).type != fs.FileType.NotFound
    except (OSError, ValueError, NotImplementedError):
        return False


def _is_folder(root: str) -> bool:
    from pyarrow import fs

    files, base = _open_root(root)
    return files.get_file_info(base).type == fs.FileType.Directory


def write_files(rows: DataFrame, folder: str, name: str, value: str, ending: str = ".txt") -> None:
    """A file ``<name>=<its value><ending>`` for each row, its text and a line end, in a folder for each partition of ``rows``.

    Rows of a partition that share a name share a file, line by line. A repeated task writes the same files again.
    ``folder`` is an address that Arrow knows, values fit for file names.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open_root(folder) if ":" in folder else _open_root(f"file:{folder}")
        target = f"{base}/part-{TaskContext.get().partitionId():05}"
        files.create_dir(target, recursive=True)
        last, lines = None, []

        def put() -> None:
            with files.open_output_stream(f"{target}/{name}={last}{ending}", compression=None) as out:
                out.write(b"".join(lines))

        for batch in batches:
            for key, line in zip(*(c.to_pylist() for c in batch.columns)):
                key = NO_NAME if key is None else key
                if lines and key != last:
                    put()
                    lines = []
                last = key
                lines.append((line or "").encode() + b"\n")
        if lines:
            put()
        yield from ()

    pairs = rows.select(col(name).cast("string").alias("name"), col(value).cast("string").alias("value"))
    pairs.sortWithinPartitions("name").mapInArrow(write, "name string").write.format("noop").mode("overwrite").save()
