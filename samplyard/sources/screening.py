"""Reading landed files that may be damaged: good and refused rows in one pass, with counts.

A reader marks every row or document with ``refused_reason``, null for good ones, and keeps the raw text
of a refused one. :func:`load_screened` writes both kinds in a single job, counts them on the way and
fails when nothing was good; the refused ones can then be read, mended and landed again.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samplyard.functions.columns import col, cols, is_blank
from samplyard.schema import SchemaSpec
from samplyard.sources.configs import DOCUMENT, documents_to_configs
from samplyard.sources.delimited import _text_options, na_to_null
from samplyard.sources.wholefiles import whole_files

FILE, TEXT, REASON, REFUSED = "source_file", "refused_text", "refused_reason", "refused"
TOO_FEW, TOO_MANY, NO_ID = "too few cells", "too many cells", "no id"
TABLE_REASONS = (TOO_FEW, TOO_MANY, NO_ID)
EMPTY, NOT_JSON, NOT_OBJECT = "empty", "not JSON", "not an object"


def cell_count(line: Column, separator: str) -> Column:
    """Cells of a raw line; separators inside quotes don't count."""
    bare = F.regexp_replace(line, r'"([^"]|"")*"', "q")
    return F.size(F.split(bare, re.escape(separator), -1))


def read_screened_table(spark: SparkSession, path: str, names: Sequence[str] | None = None, separator: str = "\t") -> DataFrame:
    """A delimited table, every column as text, with ``source_file``, ``refused_text`` and ``refused_reason``.

    A line with another number of cells than the header is refused with its text, one without an id (its first
    column) with its cells. ``names`` are those of files without a header; with a header they are looked up in
    the first file and hold for all. Blank lines are skipped, as are missing-value texts.
    """
    options = _text_options(separator) | {"header": str(names is None).lower()}
    if names is None:
        names = spark.read.options(**options, inferSchema="false").csv(path).columns
    line = "__line"
    fields = T.StructType([T.StructField(n, T.StringType()) for n in [*names, line]])
    # The parser looks at whole lines: with the columns asked for alone it would miss that some lack others.
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": line, "columnPruning": "false"}
    raw = spark.read.schema(fields).options(**options).csv(path)
    found = F.when(cell_count(col(line), separator) < len(names), TOO_FEW).otherwise(TOO_MANY)
    cells = {n: na_to_null(col(n)) for n in names}
    reason = F.when(col(line).isNotNull(), found).when(is_blank(cells[names[0]]), NO_ID)
    return raw.select(
        # Cells of a ragged line may stand in the wrong columns.
        *[F.when(col(line).isNull(), c).alias(n) for n, c in cells.items()],
        F.col("_metadata.file_path").alias(FILE),
        col(line).alias(TEXT),
        reason.alias(REASON),
    )


def document_reasons(schema: SchemaSpec) -> tuple[str, ...]:
    return (EMPTY, NOT_JSON, NOT_OBJECT, *[f"without {n}" for n in schema.required])


def read_screened_documents(spark: SparkSession, path: str, schema: SchemaSpec, pattern: str = "*.json") -> DataFrame:
    """One typed row per JSON file, with ``source_file``, ``refused_text`` and ``refused_reason``.

    Refused are files that are empty, not JSON or no object, and objects without a field the schema
    requires (the first one is named). A field of the wrong type is null, as in a table.
    """
    value = F.col("value")
    whole = whole_files(spark, path, pattern, FILE)
    is_object = F.json_object_keys(value).isNotNull()
    broken = (
        F.when(F.regexp_like(value, F.lit(r"^\s*$")), EMPTY)
        .when(F.try_parse_json(value).isNull(), NOT_JSON)
        .when(~is_object, NOT_OBJECT)
    )
    marked = whole.select(FILE, "value", broken.alias("broken"))
    parsed = marked.withColumn("document", F.when(F.col("broken").isNull(), F.from_json("value", DOCUMENT)))
    typed = documents_to_configs(parsed, schema, keep=[FILE, "value", "broken"])
    lacking = [F.when(is_blank(col(n)), F.lit(f"without {n}")) for n in schema.required]
    reason = F.coalesce("broken", *lacking)
    return typed.select(*cols(schema.names), FILE, F.when(reason.isNotNull(), F.col("value")).alias(TEXT), reason.alias(REASON))


@dataclass(frozen=True)
class Screened:
    """Good rows without the marks, refused rows with them, and rows per reason (``good`` among them)."""

    good: DataFrame
    refused: DataFrame
    counts: dict[str, int]


def load_screened(rows: DataFrame, path: str, reasons: Sequence[str], mode: str = "errorifexists") -> Screened:
    """Write marked rows once, good and refused ones into folders of their own, and count them meanwhile.

    An error when there are rows and none is good; what was refused is in the folder by then.
    """
    spark, seen = rows.sparkSession, Observation()
    tallies = [F.count_if(col(REASON) == r).alias(f"n{i}") for i, r in enumerate(reasons)]
    watched = rows.observe(seen, F.count_if(col(REASON).isNull()).alias("good"), F.count(F.lit(1)).alias("all"), *tallies)
    watched.withColumn(REFUSED, col(REASON).isNotNull()).write.mode(mode).partitionBy(REFUSED).parquet(path)
    found = seen.get
    counts = {"good": found["good"], **{r: found[f"n{i}"] for i, r in enumerate(reasons)}}
    if sum(counts.values()) != found["all"]:
        raise ValueError(f"rows were refused for reasons other than {list(reasons)}")
    if found["all"] and not found["good"]:
        raise ValueError(f"nothing of {found['all']} rows could be read, see {path}: {counts}")
    stored = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField(REFUSED, T.BooleanType())])).parquet(path)
    good = stored.filter(~col(REFUSED)).drop(REFUSED, REASON, TEXT)
    return Screened(good, stored.filter(col(REFUSED)).drop(REFUSED), counts)


def load_table(spark: SparkSession, source: str, path: str, names: Sequence[str] | None = None, separator: str = "\t") -> Screened:
    return load_screened(read_screened_table(spark, source, names, separator), path, TABLE_REASONS)


def load_documents(spark: SparkSession, source: str, path: str, schema: SchemaSpec, pattern: str = "*.json") -> Screened:
    return load_screened(read_screened_documents(spark, source, schema, pattern), path, document_reasons(schema))
