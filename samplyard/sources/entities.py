"""Entity tables landed as JSON pages, and table metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samplyard.functions.columns import col

PAGE = "results array<struct<name:string, attributes:map<string,string>>>"
METADATA = T.MapType(
    T.StringType(),
    T.StructType(
        [
            T.StructField("count", T.LongType()),
            T.StructField("idName", T.StringType()),
            T.StructField("attributeNames", T.ArrayType(T.StringType())),
        ]
    ),
)


def parse_pages(pages: DataFrame, column: str = "value") -> DataFrame:
    return pages.select(F.from_json(col(column), "struct<" + PAGE.replace(" ", ":", 1) + ">").alias("page"))


def flatten_pages(pages: DataFrame, id_name: str, attributes: Sequence[str], wanted: Sequence[str] | None = None) -> DataFrame:
    """One row per entity: ``entity:<id name>`` and a column per attribute, absent ones null.

    ``wanted`` narrows the attributes; the id always stays and is never taken from them.
    """
    names = [a for a in attributes if a != id_name and (wanted is None or a in wanted)]
    rows = pages.select(F.explode(col("page")["results"]).alias("entity"))
    values = [F.element_at(col("entity")["attributes"], F.lit(n)).alias(n) for n in names]
    return rows.select(
        F.coalesce(col("entity")["name"], F.lit("")).alias(f"entity:{id_name}"), *values
    )


def parse_metadata(text: DataFrame, column: str = "value") -> DataFrame:
    """(entity_type, count, id_name, attribute_names) rows from a metadata document."""
    return text.select(F.explode(F.from_json(col(column), METADATA)).alias("entity_type", "info")).select(
        "entity_type",
        col("info")["count"].alias("count"),
        col("info")["idName"].alias("id_name"),
        col("info")["attributeNames"].alias("attribute_names"),
    )


def table_names(spark) -> DataFrame:
    """Tables of the current database as rows."""
    return spark.sql("SHOW TABLES").select(F.col("tableName").alias("entity_type"))


def entity_by_name(df: DataFrame, name: str, key: str | None = None) -> DataFrame:
    return df.filter(col(key or df.columns[0]) == name)
