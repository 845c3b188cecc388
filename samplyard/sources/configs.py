"""Config documents: one JSON object per file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samplyard.functions.columns import col
from samplyard.functions.types import coerce
from samplyard.schema import SchemaSpec

DOCUMENT = T.MapType(T.StringType(), T.StringType())


def read_config_directory(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """(file, document) rows; a bad file has a null document."""
    files = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True)
    parsed = F.from_json(F.col("value"), DOCUMENT)
    valid = F.try_parse_json("value").isNotNull() & F.json_object_keys("value").isNotNull()
    return files.select(F.input_file_name().alias("file"), F.when(valid, parsed).alias("document"))


def split_documents(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) documents."""
    return documents.filter(col("document").isNotNull()), documents.filter(col("document").isNull())


def documents_to_configs(documents: DataFrame, schema: SchemaSpec, keep: Sequence[str] = ()) -> DataFrame:
    """One typed column per declared field; json fields stay text."""
    return documents.select(
        *[col(n) for n in keep],
        *[
            coerce(F.element_at(col("document"), F.lit(spec.name)), spec.kind, declared=spec.data_type).alias(spec.name)
            for spec in schema.fields
        ],
    )


def load_config_directory(spark: SparkSession, path: str, schema: SchemaSpec, pattern: str = "*.json") -> DataFrame:
    """Configs of all readable files; an error when there are files and none is readable."""
    good, bad = split_documents(read_config_directory(spark, path, pattern))
    if good.isEmpty() and not bad.isEmpty():
        raise RuntimeError(f"no config file in {path} could be read")
    return documents_to_configs(good, schema)
