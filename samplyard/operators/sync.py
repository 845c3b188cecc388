"""Field-level comparison of a source table with the samples table."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplyard.functions.columns import col, cols, is_blank
from samplyard.functions.types import coerce
from samplyard.operators.joins import complete, first_per_key, keyed_join
from samplyard.schema import SchemaSpec


def _typed(df: DataFrame, name: str, kind: str) -> Column:
    return coerce(col(name), kind, df.schema[name].dataType)


def sync_pairs(
    samples: DataFrame,
    source: DataFrame,
    schema: SchemaSpec,
    fields: Sequence[str],
    identifier: str,
    source_key: str | None = None,
    tie_break: Sequence[str] = (),
    scope: Sequence[str] = (),
) -> tuple[DataFrame, list[str]]:
    """Samples joined with their first source row, both sides typed; and the fields compared.

    The source is matched on ``source_key`` (its first column by default) and on ``scope``
    columns that both tables have. Of repeated source keys the first by ``tie_break`` counts.
    """
    source_key = source_key or source.columns[0]
    feeding = {}
    for name in fields:
        column = name if name in source.columns else schema.source_for(name, source.columns)
        if column and name in samples.columns:
            feeding[name] = column
    keys = [identifier, *scope]
    side = source.select(
        col(source_key).alias(identifier),
        *[col(s) for s in scope],
        *[_typed(source, c, schema.by_name[n].kind).alias(f"__source_{n}") for n, c in feeding.items()],
        *[col(t).alias(f"__tie_{i}") for i, t in enumerate(tie_break)],
    )
    order = [col(f"__tie_{i}") for i in range(len(tie_break))] or [
        col(f"__source_{n}") for n in feeding
    ]
    first = first_per_key(complete(side, keys), keys, order)
    return keyed_join(samples, first, keys, "inner"), list(feeding)


def sample_changes(
    samples: DataFrame,
    source: DataFrame,
    schema: SchemaSpec,
    fields: Sequence[str],
    identifier: str,
    overwrite: bool = False,
    allow_null: bool = False,
    key: str = "id",
    **matching,
) -> DataFrame:
    """One row per sample with anything to write: (id, identifier, scope.., ``new_<field>`` ..).

    A field's column is ``struct(value, propagate)``, null where nothing is written. Empty means
    null or ''. An empty target is filled; a different target is replaced only in overwrite mode; a
    target is cleared only when nulls may overwrite too, and a clearing is not passed on.
    """
    if allow_null and not overwrite:
        warnings.warn("allow_null does nothing without overwrite: no field is cleared", stacklevel=2)
    paired, compared = sync_pairs(samples, source, schema, fields, identifier, **matching)
    changes = {}
    for name in compared:
        new, old = col(f"__source_{name}"), _typed(samples, name, schema.by_name[name].kind)
        write = ~is_blank(new) & is_blank(old)
        if overwrite:
            write = write | (~is_blank(new) & ~old.eqNullSafe(new))
        clear = is_blank(new) & ~is_blank(old) if overwrite and allow_null else F.lit(False)
        value = F.when(~is_blank(new), new.cast("string")).alias("value")
        changes[f"new_{name}"] = F.when(write | clear, F.struct(value, (~clear).alias("propagate")))
    kept = [n for n in matching.get("scope", ()) if n not in (key, identifier)]
    rows = paired.select(col(key), col(identifier), *cols(kept), *[c.alias(n) for n, c in changes.items()])
    return rows.filter(reduce(or_, [col(n).isNotNull() for n in changes], F.lit(False)))


def changed_fields(changes: DataFrame) -> list[str]:
    return [n.removeprefix("new_") for n in changes.columns if n.startswith("new_")]


def unfolded(changes: DataFrame) -> DataFrame:
    """One row per field to write: (id, identifier, scope.., field, value, propagate)."""
    fields = changed_fields(changes)
    entries = [
        F.when(
            col(f"new_{n}").isNotNull(),
            F.struct(F.lit(n).alias("field"), col(f"new_{n}")["value"].alias("value"), col(f"new_{n}")["propagate"].alias("propagate")),
        )
        for n in fields
    ]
    kept = [n for n in changes.columns if not n.startswith("new_")]
    return changes.select(*cols(kept), F.inline(F.array_compact(F.array(*entries))))


def field_changes(
    samples: DataFrame, source: DataFrame, schema: SchemaSpec, fields: Sequence[str], identifier: str, *args, **options
) -> DataFrame:
    """:func:`sample_changes` as one row per field to write."""
    return unfolded(sample_changes(samples, source, schema, fields, identifier, *args, **options))
