"""Object paths of the form ``gs://bucket/key``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT_PATH = r"^gs://([^/]*)(?:/(.*))?$"


def is_object_path(path: Column) -> Column:
    return F.coalesce(path.startswith("gs://"), F.lit(False))


def bucket_of(path: Column) -> Column:
    return F.when(is_object_path(path), F.regexp_extract(path, OBJECT_PATH, 1))


def key_of(path: Column) -> Column:
    return F.when(is_object_path(path), F.regexp_extract(path, OBJECT_PATH, 2))


def destination_path(path: Column, destination: str, keep_structure: bool = False) -> Column:
    """Where a file goes: below the destination bucket and folder, by full key or by file name.

    Anything that is not an object path, or already lies in that bucket, stays as it is.
    """
    bucket, _, folder = destination.removeprefix("gs://").partition("/")
    prefix = f"gs://{bucket}/" + (f"{folder}/" if folder else "")
    key = key_of(path)
    tail = key if keep_structure else F.element_at(F.split(key, "/"), -1)
    moves = is_object_path(path) & (bucket_of(path) != bucket)
    return F.when(moves, F.concat(F.lit(prefix), tail)).otherwise(path)
