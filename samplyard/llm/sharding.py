"""Shards of near equal bytes by a minimax contiguous partition of ordered atomic groups.

Equal texts are one group. Groups are gathered into at most ``ATOMS`` atoms by the leading hex
digits of the text's md5, so an atom holds whole groups and the ordered list of atom sizes has a
fixed length however large the input is. Over that list:

1. an atom above the fair share of what is left gets a shard of its own (there are fewer of them
   than shards);
2. the smallest capacity for which a greedy left-to-right filling needs no more than the remaining
   shards is found by binary search, and the cuts of that filling are taken.

The slot of a row is gapless in its shard: rows of the earlier atoms, rows of the earlier slices of
its atom, and its place within (atom, slice). Slices by doc_id keep a text that a third of all rows
share from becoming one task's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from samplyard.llm.tables import partitions, staged

#: Hex digits of the md5 that name an atom; 16 ** 4 atoms at most.
ATOM_DIGITS = 4


def atom_table(rows: DataFrame, shards: int) -> DataFrame:
    """``atom``, ``shard`` and ``before`` (rows of earlier atoms in the shard) for every atom.

    Works on one row that holds the sorted list of atoms, 16 ** ATOM_DIGITS entries at most. Each step
    is written before the next one uses it: merged into the next step's lambdas, it would be computed
    again for every atom.
    """
    sizes = rows.groupBy("atom").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    listed = staged(sizes.agg(F.array_sort(F.collect_list(F.struct("atom", "size", "rows"))).alias("atoms")), "atoms")
    # The share above which an atom is alone: largest first, while it exceeds the mean of the rest.
    alone = listed.withColumn("largest", F.expr(f"slice(reverse(array_sort(transform(atoms, a -> a.size))), 1, {shards})"))
    alone = alone.withColumn(
        "state",
        F.expr(
            f"""aggregate(largest,
                named_struct('left', aggregate(atoms, 0L, (t, a) -> t + a.size), 'alone', 0, 'go', true),
                (s, x) -> if(s.go and s.alone < {shards} - 1 and x * ({shards} - s.alone) > s.left,
                    named_struct('left', s.left - x, 'alone', s.alone + 1, 'go', true),
                    named_struct('left', s.left, 'alone', s.alone, 'go', false)))"""
        ),
    )
    alone = staged(alone.select("atoms", "state"), "alone")
    # Ties with the last large atom are settled by the atom's name, so exactly state.alone are taken.
    split = alone.selectExpr(
        "state.alone AS alone",
        "state.left AS total",
        "slice(array_sort(atoms, (a, b) -> CASE WHEN a.size > b.size THEN -1 WHEN a.size < b.size THEN 1"
        " WHEN a.atom < b.atom THEN -1 WHEN a.atom > b.atom THEN 1 ELSE 0 END), 1, state.alone) AS big",
        "atoms",
    )
    split = staged(split, "big").selectExpr("alone", "total", "big", "filter(atoms, a -> not exists(big, b -> b.atom = a.atom)) AS rest")
    split = split.withColumn("room", F.lit(shards) - F.col("alone"))
    fits = """aggregate(rest, named_struct('n', 1, 'fill', 0L),
        (f, a) -> if(f.fill + a.size <= {c}, named_struct('n', f.n, 'fill', f.fill + a.size),
            named_struct('n', f.n + 1, 'fill', a.size)), f -> f.n <= room)"""
    searched = split.withColumn(
        "bounds",
        F.expr("named_struct('lo', greatest(cast(ceil(total / room) AS bigint), coalesce(array_max(transform(rest, a -> a.size)), 0L)),"
               " 'hi', cast(ceil(total / room) AS bigint) + coalesce(array_max(transform(rest, a -> a.size)), 0L))"),
    ).withColumn(
        "capacity",
        F.expr(
            f"""aggregate(sequence(1, 63), bounds,
                (s, i) -> if(s.lo >= s.hi, s, if({fits.format(c="shiftright(s.lo + s.hi, 1)")},
                    named_struct('lo', s.lo, 'hi', shiftright(s.lo + s.hi, 1)),
                    named_struct('lo', shiftright(s.lo + s.hi, 1) + 1L, 'hi', s.hi))), s -> s.lo)"""
        ),
    )
    cut = staged(searched, "capacity").withColumn(
        "cuts",
        F.expr(
            """aggregate(rest, named_struct('fill', 0L, 'cuts', cast(array() AS array<string>)),
                (s, a) -> if(s.fill + a.size <= capacity, named_struct('fill', s.fill + a.size, 'cuts', s.cuts),
                    named_struct('fill', a.size, 'cuts', array_append(s.cuts, a.atom))), s -> s.cuts)"""
        ),
    )
    placed = staged(cut, "cuts").selectExpr(
        "inline(concat("
        " transform(big, (b, i) -> named_struct('atom', b.atom, 'rows', b.rows, 'shard', i)),"
        " transform(rest, a -> named_struct('atom', a.atom, 'rows', a.rows,"
        " 'shard', alone + size(filter(cuts, c -> c <= a.atom))))))"
    )
    earlier = Window.partitionBy("shard").orderBy("atom").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("atom", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, atom`` of every row.

    A null text counts as empty and is in one group with the empty ones. Rows that are equal in
    doc_id and text take the slots of their slice in any order. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slices = partitions(docs.sparkSession)
    rows = staged(
        docs.select(
            "doc_id",
            (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.substring(F.md5(F.encode(text, "UTF-8")), 1, ATOM_DIGITS).alias("atom"),
            F.pmod(F.xxhash64("doc_id"), F.lit(slices)).alias("slice"),
        ),
        "shard-rows",
    )
    atoms = atom_table(rows, shards)
    earlier = Window.partitionBy("atom").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("atom", "slice").count()
    parts = parts.select("atom", "slice", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("earlier"))
    # The atom table has 16 ** ATOM_DIGITS rows at most, a proven bound.
    parts = parts.join(F.broadcast(atoms), "atom")
    place = F.row_number().over(Window.partitionBy("atom", "slice").orderBy("doc_id", "text_crc32")) - 1
    return (
        rows.withColumn("place", place)
        .join(parts, ["atom", "slice"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("before") + F.col("earlier") + F.col("place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "atom",
        )
    )
