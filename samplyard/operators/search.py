"""Searching rows and picking columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplyard.functions.columns import col, cols, hashable
from samplyard.operators.joins import distinct_keys, keyed_join, with_keys
from samplyard.operators.terms import first_of_each_term, matched_terms

SEED = 42  # fixed value: the shuffle seed of a filtered search


def row_search(
    df: DataFrame,
    terms: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    exact: bool = False,
    exclude: bool = False,
    max_rows: int | None = None,
    randomize: bool = False,
    order: Sequence[str] | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Rows found by any term, whole-row repeats collapsed.

    ``exclude`` negates each term on its own, so with several terms a row missing any of them is
    kept. ``max_rows`` limits each term, in ``order`` or, randomised, in a seeded hash order.
    """
    searched = [n for n in (columns or df.columns) if n in df.columns]
    if not terms:
        return _head(df, order, max_rows, randomize, seed)
    terms = list(dict.fromkeys(terms))
    matched = matched_terms(df, searched, terms, exact)
    if exclude:
        matched = F.array_except(F.sequence(F.lit(0), F.lit(len(terms) - 1)), matched)
    if max_rows is None:
        return df.filter(F.size(matched) > 0).dropDuplicates()
    return first_of_each_term(df, matched, _order(df, order, randomize, seed), max_rows)


def _order(df: DataFrame, order: Sequence[str] | None, randomize: bool, seed: int) -> list[Column]:
    by = cols(order or hashable(df))
    if randomize:
        by = [F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in by])), *by]
    return by


def _head(df: DataFrame, order: Sequence[str] | None, max_rows: int | None, randomize: bool, seed: int) -> DataFrame:
    by = _order(df, order, randomize, seed)
    if max_rows is not None:
        return df.orderBy(*by).limit(max_rows)
    return df.orderBy(*by) if randomize else df


def extract_columns(df: DataFrame, columns: Sequence[str], key: str | None = None) -> DataFrame:
    """Key column first, the others in name order; absent ones are skipped."""
    key = key or df.columns[0]
    wanted = [key, *sorted(set(columns) - {key})]
    return df.select(*cols([n for n in wanted if n in df.columns]))


def select_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose id is requested. ``ids`` has its ids in a column of the same name."""
    return with_keys(df, ids, [key])


def missing_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Requested ids the table does not have."""
    wanted = ids.select(col(key)).distinct()
    return keyed_join(wanted, distinct_keys(df, [key]), key, "left_anti")


def select_ids_strict(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Like :func:`select_ids`, but unknown ids are an error, found by the one check action here."""
    if not missing_ids(df, ids, key).isEmpty():
        raise ValueError(f"some requested ids are not in column {key!r}")
    return select_ids(df, ids, key)


def drop_controls(df: DataFrame, column: str, pattern: str, flag: str | None = None, flag_value: str = "exclude") -> DataFrame:
    """Drop rows whose name contains a control marker, and rows flagged for exclusion."""
    keep = ~F.coalesce(col(column).rlike(pattern), F.lit(False))
    if flag and flag in df.columns:
        keep = keep & ~col(flag).eqNullSafe(flag_value)
    return df.filter(keep)


def glob_pattern(glob: str) -> str:
    """Shell pattern as a regex for the whole name."""
    out, i = [], 0
    while i < len(glob):
        char = glob[i]
        end = glob.find("]", i + 2) if char == "[" else -1
        if char == "*":
            out.append(".*")
        elif char == "?":
            out.append(".")
        elif end > 0:
            body = glob[i + 1:end].replace("\\", "\\\\")
            out.append("[" + ("^" + body[1:] if body.startswith("!") else body) + "]")
            i = end
        else:
            out.append(re.escape(char))
        i += 1
    return r"(?s)\A" + "".join(out) + r"\z"


def glob_tables(tables: DataFrame, glob: str, name: str = "entity_type") -> DataFrame:
    """Table names that fit a shell pattern, without the ``_set`` tables."""
    return tables.filter(col(name).rlike(glob_pattern(glob)) & ~col(name).endswith("_set"))
