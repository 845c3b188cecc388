"""Copying and concatenating files as Spark jobs.

Rows say what to copy; tasks move bytes and nothing else. Every output is written under a
temporary name and renamed at the end, and a repeated task writes the same bytes again, so lost
executors and retries are harmless.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplyard.functions.columns import col, cols
from samplyard.functions.paths import destination_path, is_object_path
from samplyard.operators.joins import keyed_join
from samplyard.operators.ordering import running_totals
from samplyard.session import checkpoint_root

CHUNK = 1024 * 1024
BLOCK = 256 * 1024 * 1024


def copy_manifest(df: DataFrame, columns: Sequence[str], destination: str, keep_structure: bool = False) -> DataFrame:
    """Distinct (source, destination) pairs of the file columns; files already there are left out.

    ``collides`` marks destinations that several sources share.
    """
    pairs = F.array(*[F.struct(col(c).cast("string").alias("source")) for c in columns if c in df.columns])
    moves = (
        df.select(F.inline(pairs))
        .filter(is_object_path(col("source")))
        .withColumn("destination", destination_path(col("source"), destination, keep_structure))
        .filter(col("source") != col("destination"))
        .distinct()
    )
    shared = moves.groupBy("destination").agg((F.count(F.lit(1)) > 1).alias("collides"))
    return keyed_join(moves, shared, "destination", "inner").select("source", "destination", "collides")


def rewrite_paths(df: DataFrame, columns: Sequence[str], destination: str, keep_structure: bool = False) -> DataFrame:
    """The table with its file columns pointing at the destination."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: destination_path(col(c), destination, keep_structure) for c in present})


def rewrite_copied(df: DataFrame, columns: Sequence[str], results: DataFrame) -> DataFrame:
    """Rewrite only the paths whose copy succeeded."""
    done = results.filter(col("success")).select("source", "destination").distinct()
    for column in columns:
        side = done.select(col("source").alias(column), col("destination").alias("__to"))
        joined = keyed_join(df, side, column)
        df = joined.select(
            *[F.coalesce(col("__to"), col(n)).alias(n) if n == column else col(n) for n in df.columns]
        )
    return df


def _open_path(path: str, mounts: dict[str, str]):
    """(file system, path) of a file; ``mounts`` maps a bucket prefix to a folder."""
    from pyarrow import fs

    for prefix, folder in mounts.items():
        if path.startswith(prefix):
            return fs.LocalFileSystem(), folder.rstrip("/") + "/" + path[len(prefix):].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def copy_files(manifest: DataFrame, mounts: dict[str, str] | None = None, tasks: int | None = None) -> DataFrame:
    """Run a manifest: (success, source, destination, error) per row, failures kept as rows.

    The copies run now, once, however often the results are read; each attempt of a task writes
    under a name of its own.
    """
    checkpoint_root(manifest.sparkSession)
    mounts = dict(mounts or {})
    run = uuid.uuid4().hex

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        attempt = f"{run}.{TaskContext.get().taskAttemptId()}"
        for batch in batches:
            rows = []
            for source, destination in zip(batch["source"], batch["destination"]):
                error = None
                try:
                    from_fs, from_path = _open_path(source, mounts)
                    to_fs, to_path = _open_path(destination, mounts)
                    folder, _, name = to_path.rpartition("/")
                    to_fs.create_dir(folder, recursive=True)
                    temporary = f"{folder}/.tmp.{name}.{attempt}"
                    with (
                        # No compression by file extension: bytes are copied as they are.
                        from_fs.open_input_stream(from_path, compression=None) as reader,
                        to_fs.open_output_stream(temporary, compression=None) as writer,
                    ):
                        while chunk := reader.read(CHUNK):
                            writer.write(chunk)
                    to_fs.move(temporary, to_path)
                except Exception as problem:  # a failed copy is a result row, not a failed job
                    error = f"{type(problem).__name__}: {problem}"
                rows.append((error is None, source, destination, error))
            yield pd.DataFrame(rows, columns=["success", "source", "destination", "error"])

    spread = manifest.select("source", "destination").repartition(
        tasks or int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source"
    )
    return spread.mapInPandas(copy, "success boolean, source string, destination string, error string").checkpoint()


def concatenate(plan: DataFrame, folder: str, remove_sources: bool = True, block: int = BLOCK) -> DataFrame:
    """Build the outputs of a concat plan inside a folder every executor mounts.

    Each source is cut into blocks and every block is written at its own offset, so a sample
    with very many files, or one very large file, is shared by many tasks. An output is renamed
    into place only when its size is right, and sources go only after that. Where any source
    size is unknown the sizes on disk are used and the sources stay.
    Returns (output_name, success, bytes, error).
    """
    checkpoint_root(plan.sparkSession)
    folder = folder.rstrip("/")
    run = uuid.uuid4().hex

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = []
            for name in batch["file_name"]:
                path = f"{folder}/{name}"
                sizes.append(os.path.getsize(path) if os.path.exists(path) else None)
            yield batch.assign(on_disk=pd.array(sizes, dtype="Int64"))

    given = plan.select("output_name", "position", "file_name", col("size").alias("expected"))
    measured = given.mapInPandas(
        measure, "output_name string, position long, file_name string, expected long, on_disk long"
    ).checkpoint()
    measured = running_totals(measured, ["output_name"], ["position", "file_name"], "on_disk")
    totals = measured.groupBy("output_name").agg(
        F.sum("on_disk").alias("total"),
        F.when(F.count("expected") == F.count(F.lit(1)), F.sum("expected")).alias("expected_total"),
        F.count_if(col("on_disk").isNull()).alias("absent"),
    )
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(col("on_disk") - 1, F.lit(0)), F.lit(block).cast("bigint"))
    blocks = measured.filter(col("on_disk") > 0).select(
        "output_name", "file_name", "offset", "on_disk", F.explode(starts).alias("start")
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = []
            for name, source, offset, size, start in batch[
                ["output_name", "file_name", "offset", "on_disk", "start"]
            ].itertuples(index=False):
                left = min(block, size - start)
                target = os.open(f"{folder}/.tmp.{name}.{run}", os.O_WRONLY | os.O_CREAT, 0o644)
                try:
                    with open(f"{folder}/{source}", "rb") as reader:
                        reader.seek(start)
                        place = offset + start
                        while left > 0 and (chunk := reader.read(min(CHUNK, left))):
                            view = memoryview(chunk)
                            while view:
                                moved = os.pwrite(target, view, place)
                                view, place, left = view[moved:], place + moved, left - moved
                finally:
                    os.close(target)
                done.append((name, place - offset - start))
            yield pd.DataFrame(done, columns=["output_name", "bytes"])

    tasks = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = blocks.repartition(tasks, "output_name", "file_name", "start")
    written = spread.mapInPandas(write, "output_name string, bytes long").groupBy("output_name").agg(
        F.sum("bytes").alias("bytes")
    )
    # The bytes must be on disk before any output is renamed: an action, not a lazy plan.
    summary = keyed_join(totals, written, "output_name").checkpoint()

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, total, expected, absent, moved in batch[
                ["output_name", "total", "expected_total", "absent", "bytes"]
            ].itertuples(index=False):
                temporary, final = f"{folder}/.tmp.{name}.{run}", f"{folder}/{name}"
                moved = 0 if pd.isna(moved) else int(moved)
                error = None
                if absent:
                    error = f"{absent} source file(s) missing"
                elif pd.notna(expected) and int(expected) != moved:
                    error = f"size mismatch: wrote {moved}, expected {int(expected)}"
                elif moved != int(total):
                    error = f"size mismatch: wrote {moved}, sources hold {int(total)}"
                elif os.path.exists(temporary):
                    os.replace(temporary, final)
                elif moved == 0:
                    open(final, "wb").close()
                elif not (os.path.exists(final) and os.path.getsize(final) == moved):
                    error = "output disappeared"
                if error and os.path.exists(temporary):
                    os.unlink(temporary)
                out.append((name, error is None, moved, error, bool(pd.notna(expected))))
            yield pd.DataFrame(out, columns=["output_name", "success", "bytes", "error", "verified"])

    finished = summary.mapInPandas(
        finish, "output_name string, success boolean, bytes long, error string, verified boolean"
    ).checkpoint()
    if remove_sources:
        good = finished.filter(col("success") & col("verified")).select("output_name")
        gone = keyed_join(measured.select("output_name", "file_name"), good, "output_name", "left_semi")

        def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for name, output in zip(batch["file_name"], batch["output_name"]):
                    if name != output and os.path.exists(f"{folder}/{name}"):
                        os.unlink(f"{folder}/{name}")
                yield batch[["file_name"]]

        gone.mapInPandas(remove, "file_name string").write.format("noop").mode("overwrite").save()
    return finished.select(*cols(["output_name", "success", "bytes", "error"]))
