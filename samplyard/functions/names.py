"""Names of files, tables and sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: which lane tokens go. A lane token stands before the read token or at the end; group 1 is what follows it. Taking
# the rest of the name along means that only the first token is replaced.
LANE = r"(?i)[_-]L[0-9]{1,3}([_-]R[12].*|)$"


BLANKS = " \t\n\r\x0b\x0c"


def trimmed(name: Column) -> Column:
    """Without white space at either end, tabs and line ends included."""
    return F.btrim(name, F.lit(BLANKS))


def strip_lane(name: Column) -> Column:
    return F.regexp_replace(name, LANE, "$1")


def is_read(name: Column, side: int) -> Column:
    """``_R1`` or ``-R1`` somewhere in a ``.fastq.gz`` name, in any case (fixed values)."""
    text = F.lower(name)
    return text.endswith(".fastq.gz") & (text.contains(f"_r{side}") | text.contains(f"-r{side}"))


def read_side(name: Column) -> Column:
    """``R1``, ``R2`` or null. A name that fits both counts as R1 here."""
    return F.when(is_read(name, 1), "R1").when(is_read(name, 2), "R2")


def set_name(prefix: Column, as_of: Column, zone: str = "UTC") -> Column:
    """``<prefix>_<local date and time>``; ``as_of`` is a UTC ``timestamp_ntz``."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), as_of)
    return F.concat(prefix, F.lit("_"), F.date_format(local, "yyyyMMdd_HHmmss"))


def entity_id_column(target: str) -> str:
    return f"entity:{target.removesuffix('_id')}_id"


def file_stem(path: Column) -> Column:
    """File name without folders and without its last extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def safe_name(name: Column) -> Column:
    return F.regexp_replace(name, r"[^\p{L}\p{N}_.\-]+", "_")


def without_suffix(name: Column, suffix: str) -> Column:
    return F.when(name.endswith(suffix), F.substring(name, F.lit(1), F.length(name) - len(suffix))).otherwise(name)


def megabytes(size: Column) -> Column:
    return size / F.lit(1_000_000)


def megabyte_text(size: Column) -> Column:
    """Two decimals, rounded by the true binary value as C and Python print it."""
    return F.concat(F.call_function("format_number", megabytes(size), F.lit("0.00")), F.lit(" MB"))
