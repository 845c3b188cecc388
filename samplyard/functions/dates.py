"""Date parsing and formatting as column expressions.

Text is first rearranged into ISO order by its shape and then cast, so no value goes through a
chain of failing formatters. A zone suffix is cut off and kept: formatting prints the wall time
with its own offset, storing into a zone-less column moves it to UTC.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named layouts and the Spark pattern each one prints.
NAMED_LAYOUTS = {
    "YYYY-MM-DD": "yyyy-MM-dd",
    "MM/DD/YYYY": "MM/dd/yyyy",
    "DD/MM/YYYY": "dd/MM/yyyy",
    "YYYY/MM/DD": "yyyy/MM/dd",
}
ISO_LAYOUTS = ("ISO 8601", "ISO8601", "RFC 3339", "RFC3339")

# Strftime directive -> (Spark letters, letters when the width may vary).
DIRECTIVES = {
    "Y": ("yyyy", "yyyy"),
    "m": ("MM", "M"),
    "d": ("dd", "d"),
    "H": ("HH", "H"),
    "I": ("hh", "h"),
    "M": ("mm", "m"),
    "S": ("ss", "s"),
    "f": ("SSSSSS", "SSSSSS"),
    "b": ("MMM", "MMM"),
    "B": ("MMMM", "MMMM"),
    "j": ("DDD", "D"),
    "y": ("yy", "yy"),
    "p": ("a", "a"),
}

# A zone suffix counts only after a time of day.
ZONED = r"(?:\d:\d{2}(?::\d{2}(?:\.\d+)?)?|\d{8}T\d{4,6})\s*(Z|[+-]\d{2}(?::?\d{2})?)\s*$"

# Whole text of a time in UTC, whose cast needs no rewriting.
ISO_UTC = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?Z$"

# One pattern for all numeric layouts, and the parts in ISO order: year-month-day
# hour:minute:second. A date starting with 01..12 is read month first, any other day first. The
# last branch takes any other text and leaves the parts empty.
NUMERIC = (
    r"(?s)^\s*(?:"
    r"(\d{4})([/.-])(\d{1,2})\2(\d{1,2})"
    r"|(0?[1-9]|1[0-2])([/.-])(\d{1,2})\6(\d{4})"
    r"|(\d{1,2})([/.-])(\d{1,2})\10(\d{4})"
    r"|(\d{4})(\d{2})(\d{2})"
    r")(?:(?:[T ]|(?<=\b\d{8})(?=\d{4}))(\d{1,2})(?::?(\d{2})(?::?(\d{2})(\.\d+)?)?)?"
    r"\s*(?:Z|[+-]\d{2}(?::?\d{2})?)?)?\s*$|^.*$"
)
PARTS = "$1$8$12$13-$3$5$11$14-$4$7$9$15 $16:$17:$18$19"

SHORT_YEAR = ((r"^(\d{1,2})/(\d{1,2})/([0-6]\d)$", "20$3-$1-$2"), (r"^(\d{1,2})/(\d{1,2})/([7-9]\d)$", "19$3-$1-$2"))
REDUCED = r"^(?:\d{4}(?:-\d{2})?|(?:19|20)\d{2}-\d{1,2}-\d{1,2})$"

# Dates with a month name, towards year, month, day.
WORDED = (
    (r"(?i)^([a-z]{3})[a-z]*\.?\s+(\d{1,2}),?\s+(\d{4})", "$3 $1 $2"),
    (r"(?i)^(\d{1,2})[ -]([a-z]{3})[a-z]*\.?,?[ -](\d{4})", "$3 $2 $1"),
)


def check_date_format(layout: str) -> None:
    if layout in NAMED_LAYOUTS or layout in ISO_LAYOUTS:
        return
    if "%" not in layout:
        raise ValueError(f"unsupported date format: {layout}")
    spark_pattern(layout)


def spark_pattern(strftime: str, parsing: bool = False) -> str:
    """Spark datetime pattern for a strftime layout; unknown directives are refused.

    For parsing, a directive next to a separator may have fewer digits, as strptime allows.
    """
    parts = re.findall(r"%.|[^%]+", strftime, flags=re.S)
    out = []
    for index, part in enumerate(parts):
        if part == "%%":
            out.append("%")
        elif part.startswith("%"):
            if part[1:] not in DIRECTIVES:
                raise ValueError(f"unsupported date directive {part} in {strftime!r}")
            fixed, loose = DIRECTIVES[part[1:]]
            beside = parts[max(index - 1, 0):index] + parts[index + 1:index + 2]
            packed = any(b.startswith("%") and b != "%%" for b in beside)
            out.append(loose if parsing and not packed else fixed)
        else:
            out.append(re.sub(r"[A-Za-z']+", lambda m: "'" + m.group().replace("'", "''") + "'", part))
    return "".join(out)


def _rewrite(text: Column, rules) -> Column:
    for shape, order in rules:
        text = F.regexp_replace(text, shape, order)
    return text


def _iso_week(value: Column) -> Column:
    first_monday = F.date_trunc("week", F.make_date(F.substring(value, 1, 4).try_cast("int"), F.lit(1), F.lit(4)))
    week = F.regexp_extract(value, r"W(\d{2})", 1).try_cast("int")
    day = F.regexp_extract(value, r"W\d{2}-?(\d)", 1).try_cast("int")
    days = week * 7 + F.coalesce(day, F.lit(1)) - 8
    shape = r"^\d{4}-?W\d{2}(?:-?[1-7])?$"
    return F.when(value.rlike(shape), F.date_add(first_monday.cast("date"), days).cast("timestamp_ntz"))


def zone_of(value: Column) -> Column:
    """Offset of a date text as ``+HH:MM``, '' when it names none."""
    rules = ((r"^Z$", "+00:00"), (r"^([+-]\d{2})$", "$1:00"), (r"^([+-]\d{2})(\d{2})$", "$1:$2"))
    return _rewrite(F.regexp_extract(value, ZONED, 1), rules)


def parse_wall(value: Column, layout: str | None = None) -> Column:
    """Wall-clock ``timestamp_ntz`` of a date text, null when no layout fits.

    Order: the field's own strftime layout, numeric layouts (ISO, month first, day first), then
    two-digit years, month names, bare years and ISO weeks. Nearly all text ends at the numeric
    pattern, which costs one regex and one cast. The generated code is kept small on purpose:
    the JVM does not compile very long methods.
    """
    tries = []
    if layout and "%" in layout:
        pattern = spark_pattern(layout, parsing=True)
        tries.append(F.try_to_timestamp(F.trim(value), F.lit(pattern)).cast("timestamp_ntz"))
    tries.append(F.rtrim(F.regexp_replace(value, NUMERIC, PARTS), F.lit(" :")).try_cast("timestamp_ntz"))
    worded = F.try_to_timestamp(_rewrite(F.trim(value), WORDED), F.lit("yyyy MMM d[ H:mm[:ss]]"))
    tries.append(F.when(value.rlike("[A-Za-z]{3}"), worded.cast("timestamp_ntz")))
    tries.append(F.regexp_extract(_rewrite(F.trim(value), SHORT_YEAR), REDUCED, 0).try_cast("timestamp_ntz"))
    tries.append(_iso_week(F.trim(value)))
    return F.coalesce(*tries)


def parse_utc(value: Column, layout: str | None = None) -> Column:
    """Like :func:`parse_wall`, with text that names a zone moved to UTC.

    ISO text in UTC, as services write it, is told by its shape and cast as it stands; a layout of
    the field's own is tried before it.
    """
    any_text = _parse_any_utc(value, layout)
    if layout and "%" in layout:
        return any_text
    return F.coalesce(F.when(value.rlike(ISO_UTC), value.try_cast("timestamp_ntz")), any_text)


def _parse_any_utc(value: Column, layout: str | None) -> Column:
    zone = F.regexp_extract(value, ZONED, 1)
    tail = F.when(F.length(zone) > 3, F.substring(zone, -2, 2).cast("int")).otherwise(0)
    east = F.substring(zone, 2, 2).cast("int") * 60 + tail
    signed = F.when(zone.startswith("-"), -east).otherwise(east)
    # Only text with a real offset pays for reading it.
    minutes = F.when(zone.isin("", "Z"), 0).otherwise(signed)
    return parse_wall(value, layout) - F.make_dt_interval(F.lit(0), F.lit(0), minutes)


EPOCH = "1970-01-01 00:00:00"


def utc_instant(wall: Column) -> Column:
    """The instant a zone-less UTC time stands for, whatever the session's zone and its clock changes."""
    since = (wall - F.lit(EPOCH).cast("timestamp_ntz")).cast("interval second").cast("decimal(20,6)")
    return F.timestamp_micros((since * 1_000_000).cast("bigint"))


def utc_wall(instant: Column) -> Column:
    """UTC wall time of an instant."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    none = F.lit(0)
    return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(none, none, none, seconds)


def iso_text(wall: Column, zone: Column | None = None) -> Column:
    """ISO text; microseconds appear only when there are some."""
    text = F.regexp_replace(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", "")
    return text if zone is None else F.concat(text, zone)


def format_date(value: Column, layout: str) -> Column:
    """Rewrite a date text in the wanted layout, null when it is no date."""
    wall = parse_wall(value, layout)
    if layout in NAMED_LAYOUTS:
        return F.date_format(wall, NAMED_LAYOUTS[layout])
    if "%" in layout:
        return F.date_format(wall, spark_pattern(layout))
    return iso_text(wall, zone_of(value))
