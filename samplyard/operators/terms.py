"""Searching a table for many terms in one scan.

A term is a regex, looked for in lower-cased cells. Testing every cell against every term costs rows
times terms. Most terms have a literal stretch that each hit must contain, so three characters of it
stand for the term: one pass over a cell tells which of these grams occur. Only terms whose gram and
longest stretch occur are tried as regexes, or are found if that stretch is the whole term. Terms
without such a stretch are always tried.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplyard.functions.columns import col, cols, hashable

#: Characters that stand for a term.
GRAM = 3


def literal_stretches(pattern: str) -> list[str]:
    """Texts that every match of the regex contains; none where that is not easily told."""
    if "|" in pattern or "(?" in pattern or re.search(r"\\[^\WsSdDwWbB]", pattern):
        return []
    out, i = [""], 0
    while i < len(pattern):
        char = pattern[i]
        if char in "([":
            # What is in brackets, or in a group, may be optional or one of several.
            i, char = _closing(pattern, i), ""
        elif char == "\\":
            i, char = i + 1, ""
        elif char in ".^$)]{}?*+":
            char = ""
        after = pattern[i + 1 : i + 2]
        if char and not (after and after in "?*{"):
            out[-1] += char
        else:
            out.append("")
        if after == "+":
            out.append("")
        if after == "{":
            i = max(i, pattern.find("}", i) - 1)
        i += 1
    return [text for text in out if text]


def _closing(pattern: str, start: int) -> int:
    """Where the bracket or group that opens at ``start`` ends."""
    depth, i, inside = 0, start, False
    while i < len(pattern):
        char = pattern[i]
        if char == "\\":
            i += 1
        elif inside:
            # A ] right after [ or [^ is a member.
            inside = char != "]" or pattern[i - 1] == "[" or pattern[i - 2 : i] == "[^"
            depth -= not inside
        elif char == "[":
            inside, depth = True, depth + 1
        elif char in "()":
            depth += 1 if char == "(" else -1
        if not depth:
            return i
        i += 1
    return i


def grams_of(patterns: Sequence[str]) -> list[str | None]:
    """A gram for each pattern: the one that fewest of the others contain, then the least."""
    options = [{t[i : i + GRAM] for t in literal_stretches(p) for i in range(len(t) - GRAM + 1)} for p in patterns]
    uses = Counter(gram for grams in options for gram in grams)
    return [min(grams, key=lambda gram: (uses[gram], gram)) if grams else None for grams in options]


def gram_finder(grams: Sequence[str]) -> str:
    """A regex whose only group takes each gram wherever it starts, overlaps included."""
    def tree(rest: set[str]) -> str:
        heads = sorted({gram[0] for gram in rest})
        parts = [re.escape(head) + (tree({g[1:] for g in rest if g[0] == head}) if len(next(iter(rest))) > 1 else "") for head in heads]
        return "(?:" + "|".join(parts) + ")"

    heads = "".join(re.escape(head) for head in sorted({gram[0] for gram in grams}))
    return f"(?=[{heads}]){tree(set(grams)).replace('(?:', '(?=(', 1)})"


def _constant(value: list, kind: str) -> Column:
    """A nested constant as one expression: built from columns, many terms take seconds to plan."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def matched_terms(df: DataFrame, columns: Sequence[str], terms: Sequence[str], exact: bool = False) -> Column:
    """Positions in ``terms``, ascending, of the terms that any of the columns has; nulls have none.

    ``exact`` takes terms as whole cells, upper and lower case told apart.
    """
    none = F.array().cast("array<int>")
    names = [n for n in columns if n in df.columns]
    if not terms or not names:
        return none
    texts = [col(n).cast("string") for n in names]
    if exact:
        lists = _constant([{"i": i, "term": term} for i, term in enumerate(terms)], "array<struct<i int, term string>>")
        cells = F.array(*texts)
        hits = F.filter(lists, lambda t: F.coalesce(F.array_contains(cells, t["term"]), F.lit(False)))
        return F.transform(hits, lambda t: t["i"])
    patterns = [term.lower() for term in terms]
    grams = grams_of(patterns)
    parts = [max(literal_stretches(pattern), key=len, default="") for pattern in patterns]
    lists = _constant(
        [{"i": i, "gram": gram, "part": part, "pattern": pattern} for i, (gram, part, pattern) in enumerate(zip(grams, parts, patterns))],
        "array<struct<i int, gram string, part string, pattern string>>",
    )
    known = [gram for gram in grams if gram]

    def hits(text: Column) -> Column:
        text = F.lower(text)
        # Distinct at once: a long text repeats its grams.
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(gram_finder(known)), F.lit(1))) if known else F.array().cast("array<string>")
        pair = F.array(F.struct(text.alias("text"), found.alias("found")))
        # The pair is made once for a cell, not once for a term.
        tried = F.flatten(F.transform(pair, lambda p: F.filter(
            lists,
            lambda t: (t["gram"].isNull() | F.array_contains(p["found"], t["gram"]))
            & F.contains(p["text"], t["part"])
            & ((t["part"] == t["pattern"]) | F.call_function("rlike", p["text"], t["pattern"])),
        )))
        return F.coalesce(F.transform(tried, lambda t: t["i"]), none)

    return F.array_sort(F.array_distinct(F.concat(*[hits(text) for text in texts])))


def term_hits(df: DataFrame, terms: Sequence[str], columns: Sequence[str], key: Sequence[str], exact: bool = False) -> DataFrame:
    """``term`` and the key columns, a row for each term that a row has; one scan, no shuffle.

    Only key and searched columns are read. A term that is given twice is found once.
    """
    terms = list(dict.fromkeys(terms))
    if not terms:
        return df.select(F.lit("").alias("term"), *cols(key)).limit(0)
    # The outer form: a plain explode puts a filter before itself that finds all terms once more.
    at = df.select(*cols(key), F.explode_outer(matched_terms(df, columns, terms, exact)).alias("_term")).filter("_term IS NOT NULL")
    return at.select(F.element_at(_constant(terms, "array<string>"), F.col("_term") + 1).alias("term"), *cols(key))


def first_of_each_term(df: DataFrame, matched: Column, by: Sequence[Column], max_rows: int) -> DataFrame:
    """Rows among the first ``max_rows`` of any term of theirs (``matched``, positions), repeats collapsed.

    Ranked are (term, order, digest of the row); each task keeps its own first rows of a term before
    anything is shuffled, so a term of very many rows is no one's work. The digests that stay, at most
    terms times ``max_rows``, pick the rows in a second scan; of rows that are equal in ``by``, those of
    the least digests come first.
    """
    digest = F.md5(F.to_json(F.struct(*cols(hashable(df)))))
    order = [f"_o{i}" for i in range(len(by))]
    ranked = df.select(F.explode_outer(matched).alias("_term"), *[c.alias(o) for c, o in zip(by, order)], digest.alias("_digest"))
    ranked = ranked.filter("_term IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("_term").orderBy(*order, "_digest"))
    chosen = ranked.withColumn("_place", place).filter(F.col("_place") <= max_rows).select("_digest").distinct()
    rows = df.withColumn("_digest", digest).join(chosen, "_digest", "left_semi")
    return rows.drop("_digest").dropDuplicates(hashable(df))
