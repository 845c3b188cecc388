"""Declared table schemas: YAML or dict in, Spark ``StructType`` out.

Field attributes travel in ``StructField.metadata``, so a DataFrame read back from a table
still knows its identifier, its sequence files and so on.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import types as T

from samplyard.functions.dates import check_date_format

# Accepted type names and what each one becomes; other names are text.
TYPE_NAMES = {
    "string": "string",
    "str": "string",
    "integer": "integer",
    "int": "integer",
    "float": "float",
    "boolean": "boolean",
    "bool": "boolean",
    "datetime": "datetime",
    "timestamp": "timestamp",
    "date": "date",
    "record": "record",
    "array": "array",
    "object": "json",
    "json": "json",
}

SCALARS = {
    "string": T.StringType(),
    "json": T.StringType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
    "datetime": T.TimestampNTZType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}

STRUCTURE_KEYS = {"type", "description", "required", "fields", "items"}
CONFIG_KEY_SPELLINGS = ("config_identifier", "configuration_identifier", "config_id")


@dataclass(frozen=True)
class FieldSpec:
    name: str
    kind: str = "string"
    required: bool = False
    description: str = ""
    attributes: Mapping[str, Any] = field(default_factory=dict)
    children: tuple["FieldSpec", ...] = ()

    @classmethod
    def parse(cls, name: str, body: Mapping[str, Any]) -> "FieldSpec":
        kind = TYPE_NAMES.get(str(body["type"]).lower(), "string")
        children: tuple[FieldSpec, ...] = ()
        if kind == "record":
            children = tuple(cls.parse(n, b) for n, b in body.get("fields", {}).items())
        elif kind == "array":
            if "items" not in body:
                raise ValueError(f"array field {name!r} needs 'items'")
            children = (cls.parse("element", body["items"]),)
        attributes = {k: v for k, v in body.items() if k not in STRUCTURE_KEYS}
        if isinstance(attributes.get("column_mappings"), str):
            attributes["column_mappings"] = [attributes["column_mappings"]]
        if attributes.get("accepted_pattern"):
            try:
                re.compile(attributes["accepted_pattern"])
            except re.error as error:
                raise ValueError(f"bad accepted_pattern on {name!r}: {error}") from error
        if attributes.get("date_format"):
            check_date_format(attributes["date_format"])
        return cls(
            name,
            kind,
            bool(body.get("required", False)),
            body.get("description", "") or "",
            attributes,
            children,
        )

    @property
    def data_type(self) -> T.DataType:
        if self.kind == "record":
            return T.StructType([child.struct_field for child in self.children])
        if self.kind == "array":
            return T.ArrayType(self.children[0].data_type)
        return SCALARS[self.kind]

    @property
    def struct_field(self) -> T.StructField:
        metadata = {
            "kind": self.kind,
            "required": self.required,
            "description": self.description,
            "attributes": json.dumps(dict(self.attributes)),
        }
        return T.StructField(self.name, self.data_type, True, metadata)

    @property
    def source_columns(self) -> list[str]:
        """Columns that can feed this field when its name alone does not decide it."""
        if self.attributes.get("column_mappings"):
            return list(self.attributes["column_mappings"])
        return [self.name] if self.attributes.get("use_field_name") else []


@dataclass(frozen=True)
class SchemaSpec:
    fields: tuple[FieldSpec, ...]

    @classmethod
    def from_dict(cls, body: Mapping[str, Any]) -> "SchemaSpec":
        return cls(tuple(FieldSpec.parse(n, b) for n, b in body["fields"].items()))

    @classmethod
    def from_yaml(cls, source: str | Path) -> "SchemaSpec":
        """``source`` is a file path, or YAML text holding a ``fields:`` block."""
        text = source if isinstance(source, str) and "\n" in source else Path(source).read_text()
        return cls.from_dict(yaml.safe_load(text))

    @classmethod
    def from_struct(cls, struct: T.StructType) -> "SchemaSpec":
        """Rebuild the declaration from a DataFrame schema written by :attr:`struct`."""
        def back(item: T.StructField) -> FieldSpec:
            meta = item.metadata or {}
            children: tuple[FieldSpec, ...] = ()
            if isinstance(item.dataType, T.StructType):
                children = tuple(back(child) for child in item.dataType.fields)
            elif isinstance(item.dataType, T.ArrayType):
                children = (back(T.StructField("element", item.dataType.elementType)),)
            kind = meta.get("kind") or _kind_of(item.dataType)
            return FieldSpec(
                item.name,
                kind,
                meta.get("required", False),
                meta.get("description", ""),
                json.loads(meta.get("attributes", "{}")),
                children,
            )

        return cls(tuple(back(item) for item in struct.fields))

    @cached_property
    def by_name(self) -> dict[str, FieldSpec]:
        return {item.name: item for item in self.fields}

    @property
    def names(self) -> list[str]:
        return [item.name for item in self.fields]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([item.struct_field for item in self.fields])

    def having(self, *attributes: str) -> list[str]:
        """Names of fields on which any of the attributes is set."""
        return [f.name for f in self.fields if any(f.attributes.get(a) for a in attributes)]

    def first_having(self, *attributes: str) -> str | None:
        return next(iter(self.having(*attributes)), None)

    @property
    def identifier(self) -> str | None:
        return self.first_having("sample_identifier")

    @property
    def config_key(self) -> str | None:
        return self.first_having(*CONFIG_KEY_SPELLINGS)

    @property
    def primary_keys(self) -> list[str]:
        return self.having("primary_key")

    @property
    def sequence_files(self) -> list[str]:
        return self.having("sequence_file")

    @property
    def sync_fields(self) -> list[str]:
        return self.having("sync_field")

    @property
    def system_fields(self) -> list[str]:
        return [f.name for f in self.fields if f.attributes.get("system_value") is True]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    @property
    def inherited(self) -> dict[str, str]:
        """field -> config column it is copied from"""
        return self._values("inherit_from_config")

    @property
    def patterns(self) -> dict[str, str]:
        return self._values("accepted_pattern")

    @property
    def date_formats(self) -> dict[str, str]:
        return self._values("date_format")

    def _values(self, attribute: str) -> dict[str, Any]:
        return {
            f.name: f.attributes[attribute] for f in self.fields if f.attributes.get(attribute)
        }

    def source_for(self, name: str, available: list[str]) -> str | None:
        """First mapped source column of the field that the table really has."""
        mappings = self.by_name[name].attributes.get("column_mappings") if name in self.by_name else None
        return next((source for source in mappings or [] if source in available), None)

    @property
    def identifier_sources(self) -> list[str]:
        """Configured source columns of the identifier; empty means the entity id column."""
        return self.by_name[self.identifier].source_columns if self.identifier else []

    def check_fields(self, names) -> None:
        unknown = sorted(set(names) - set(self.names))
        if unknown:
            raise ValueError(f"fields not in schema: {unknown}")


def _kind_of(data_type: T.DataType) -> str:
    if isinstance(data_type, T.StructType):
        return "record"
    if isinstance(data_type, T.ArrayType):
        return "array"
    for kind in ("integer", "float", "boolean", "datetime", "timestamp", "date"):
        if isinstance(data_type, type(SCALARS[kind])):
            return kind
    if isinstance(data_type, T.IntegralType):
        return "integer"
    if isinstance(data_type, (T.FloatType, T.DecimalType)):
        return "float"
    return "string"
