"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(name: str = "samplyard", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the operators are tuned for.

    On a cluster the master comes from spark-submit; ``conf`` entries use ``__`` for dots.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # The JVM interprets methods of more than 8000 bytes for good. Beyond that, expressions are
        # compiled one by one, in methods of their own, instead of with the whole stage.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # Recording a call site per column makes building wide plans slow.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Folder shared by all executors, read from ``spark.checkpoint.dir``.

    A temporary folder is made only in local mode, where driver and executors are one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="samplyard-")
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder for one staged table."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders, sorted; none where the folder is missing. Works on every store Spark reads."""
    files, place = _hadoop(spark, path)
    if not files.exists(place):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory())


def glob_paths(spark: SparkSession, path: str) -> list[str]:
    """The full addresses of what the path, or pattern, stands for; none where nothing is there."""
    files, place = _hadoop(spark, path)
    return [s.getPath().toString() for s in files.globStatus(place) or []]


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a job has written the folder to the end."""
    files, place = _hadoop(spark, f"{path.rstrip('/')}/_SUCCESS")
    return files.exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, place = _hadoop(spark, path)
    files.delete(place, True)
