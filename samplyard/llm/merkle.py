"""Merkle manifest of a data set: trees of runs of three over the leaves of each source and over the
sources' roots.

A tree is built by aligned blocks of ``WIDTH`` = 3 ** ``DEPTH`` nodes, whatever its size. A block keeps
every level as one string of 64-digit digests: a parent is the hash of a fixed-width substring of three
of them, and a node's siblings are the substrings to the left and to the right of it in its run. The
blocks' top nodes are the nodes of the next tier, until one node is left. Blocks have a fixed size, so
one source may hold any share of the rows; only the single root reaches the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplyard.llm.tables import partitions, staged

FAN = 3
DEPTH = 5
WIDTH = FAN**DEPTH
DIGITS = 64
#: The rows of a partition are numbered in the lower bits of monotonically_increasing_id.
ROW_BITS = (1 << 33) - 1
STEP = "struct<left: string, right: string>"


def hashed(*parts: Column | str) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column | str) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and value."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``place`` (from 0) in the ``tree`` by the given order and the ``size`` of the tree.

    Rows are cut into ranges of (tree, order), sorted and written; the counts of (tree, range), few
    rows per tree, shift the numbers within a range. ``order`` has to tell all rows apart that are to
    be spread over several ranges.
    """
    spark = nodes.sparkSession
    ranged = nodes.repartitionByRange(partitions(spark), "tree", *order).sortWithinPartitions("tree", *order)
    numbered = staged(
        ranged.withColumns(
            {"range": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS))}
        ),
        "ranges",
    )
    parts = numbered.groupBy("tree", "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    in_tree = Window.partitionBy("tree")
    earlier = in_tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "tree",
        "range",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(in_tree).alias("size"),
    )
    return numbered.join(starts, ["tree", "range"]).select(
        *nodes.columns, (F.col("at") + F.col("shift")).alias("place"), "size"
    )


def parents(level: Column) -> Column:
    """The next level: one digest for every three, or for what is left of them at the end."""
    runs = F.ceil(F.length(level) / F.lit(FAN * DIGITS)).cast("int")
    starts = F.sequence(F.lit(0), runs - 1)
    return F.array_join(F.transform(starts, lambda i: F.sha2(F.substring(level, i * (FAN * DIGITS) + 1, F.lit(FAN * DIGITS)), 256)), "")


def blocks_of(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """``tree, block, size, members, levels`` from ``tree, place, size, node`` and carried columns.

    A block climbs ``DEPTH`` levels, or, when it is the whole tree, until a single node is left.
    """
    members = F.array_sort(F.collect_list(F.struct("place", "node", *carried)))
    blocks = nodes.groupBy("tree", F.floor(F.col("place") / WIDTH).alias("block")).agg(
        F.first("size").alias("size"), members.alias("members")
    )
    last = lambda levels: F.element_at(levels, -1)
    climb = lambda levels, _: F.when(
        (F.col("size") > WIDTH) | (F.length(last(levels)) > DIGITS), F.array_append(levels, parents(last(levels)))
    ).otherwise(levels)
    leaves = F.array(F.array_join(F.transform("members", lambda m: m["node"]), ""))
    levels = F.aggregate(F.array(*[F.lit(i) for i in range(DEPTH)]), leaves, climb)
    return blocks.withColumn("levels", levels)


def siblings(place: Column) -> Column:
    """Of the node at a place of the block: for each level the digests left and right of it in its run."""
    at = F.pmod(place, F.lit(WIDTH)).cast("int")
    spans = F.slice(F.array(*[F.lit(FAN**i) for i in range(DEPTH)]), F.lit(1), F.size("levels") - 1)

    def step(span: Column, i: Column) -> Column:
        level = F.element_at("levels", i + 1)
        node = F.floor(at / span).cast("int")
        start = node - F.pmod(node, F.lit(FAN))
        left = F.substring(level, start * DIGITS + 1, (node - start) * DIGITS)
        right = F.substring(level, (node + 1) * DIGITS + 1, (start + (FAN - 1) - node) * DIGITS)
        return F.struct(left.alias("left"), right.alias("right"))

    return F.transform(spans, step)


def climb(nodes: DataFrame, carried: list[str]) -> list[DataFrame]:
    """The blocks of every tier, written; the last tier has only trees that end in it."""
    tiers = []
    while True:
        blocks = staged(blocks_of(nodes, carried if not tiers else []), f"tier{len(tiers)}")
        tiers.append(blocks)
        if not blocks.filter(F.col("size") > WIDTH).limit(1).count():
            return tiers
        nodes = blocks.filter(F.col("size") > WIDTH).select(
            "tree",
            F.col("block").alias("place"),
            F.ceil(F.col("size") / WIDTH).alias("size"),
            F.element_at("levels", -1).alias("node"),
        )


def tops(tiers: list[DataFrame]) -> list[DataFrame]:
    """``tree, node`` of the trees that end in each tier."""
    return [t.filter(F.col("size") <= WIDTH).select("tree", F.element_at("levels", -1).alias("node")) for t in tiers]


def descend(tiers: list[DataFrame], above: list[DataFrame], carried: list[str]) -> DataFrame:
    """``tree, node, path`` and the carried columns of every leaf.

    ``above`` gives, for the trees that end in each tier, ``tree``, the ``path`` from there on and
    ``top``. Every block meets one row, that of its top node in the next tier.
    """
    rows = None
    for i in reversed(range(len(tiers))):
        ends = above[i].select("tree", F.lit(0).cast("bigint").alias("block"), "path", "top")
        over = ends if rows is None else ends.unionByName(rows.select("tree", F.col("place").alias("block"), "path", "top"))
        own = carried if i == 0 else []
        leaf = lambda m: F.struct(
            m["place"].alias("place"), m["node"].alias("node"), *[m[c].alias(c) for c in own],
            F.concat(siblings(m["place"]), F.col("upper")).alias("path"),
        )
        joined = tiers[i].join(over.withColumnRenamed("path", "upper"), ["tree", "block"])
        rows = joined.select("tree", "top", F.inline(F.transform("members", leaf)))
    return rows.select("tree", "top", "node", "path", *carried)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, step: hashed(step["left"], node, step["right"]))


def proof(path: Column) -> Column:
    """All siblings of a path in one string."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def proofs(leaves: DataFrame, carried: list[str]) -> DataFrame:
    """``tree, subroot, root, node, path`` and the carried columns of every leaf.

    ``leaves`` has ``tree`` (not null), ``node`` (64 hex digits), ``place`` and ``size``; the trees are
    ordered by their name, bytewise. An empty table gives no rows.
    """
    tiers = climb(leaves, carried)
    ends = tops(tiers)
    trees = reduce(DataFrame.unionByName, (e.withColumn("tier", F.lit(i)) for i, e in enumerate(ends)))
    listed = placed(trees.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node", "tier"), ["name"])
    upper = climb(listed, ["name", "tier"])
    no_path = F.array().cast(f"array<{STEP}>")
    above = [e.select("tree", no_path.alias("path"), F.col("node").alias("top")) for e in tops(upper)]
    subroots = descend(upper, above, ["name", "tier"]).select(
        F.col("name").alias("tree"), "path", F.struct(F.col("node").alias("subroot"), F.col("top").alias("root")).alias("top"), "tier"
    )
    subroots = staged(subroots, "subroots")
    rows = descend(tiers, [subroots.filter(F.col("tier") == i).drop("tier") for i in range(len(tiers))], carried)
    return rows.select("tree", "top.subroot", "top.root", "node", "path", *carried)


def document_leaves(docs: DataFrame) -> DataFrame:
    """``tree, node, doc_id, spoilt``: the leaf of every row, and for rows whose doc_id has an even crc32
    that of the row with line feeds deleted from its text."""
    facts = [field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    chosen = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(2)) == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree"),
        hashed(*facts, field("text")).alias("node"),
        "doc_id",
        F.when(chosen & F.contains("text", F.lit("\n")), hashed(*facts, field(F.replace("text", F.lit("\n"), F.lit(""))))).alias("spoilt"),
        F.monotonically_increasing_id().alias("row"),
    )


def document_proofs(docs: DataFrame) -> DataFrame:
    """``doc_id, source, leaf, subroot, root, path, spoilt`` of every row of documents.

    Leaves of a source ascend by doc_id, null first; rows that share a doc_id are ordered by their
    leaf, equal ones are leaves of their own. A null source is a tree of its own, before all others; a
    null in any column is ``-``, unlike an empty text. ``spoilt`` is null where nothing was tampered
    with, rows without a doc_id included. An empty table gives no rows. Other columns are left out.
    """
    # The row number only spreads equal rows over ranges: it is written before anything uses it.
    leaves = placed(staged(document_leaves(docs), "leaves"), ["doc_id", "node", "row"])
    rows = proofs(leaves, ["doc_id", "spoilt"])
    source = F.when(F.col("tree") != "", F.substring("tree", F.lit(2), F.length("tree")))
    return rows.select("doc_id", source.alias("source"), F.col("node").alias("leaf"), "subroot", "root", "path", "spoilt")


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``; see :func:`document_proofs`."""
    rows = document_proofs(docs)
    folded = rows.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(proof(F.col("path")), 256).alias("proof_sha256"),
        fold(F.coalesce("spoilt", "leaf"), F.col("path")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE = """
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) AS spoilt,
         list_reduce(
           list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
             lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda crc, b: CASE WHEN b >= 0 THEN xor(crc, b) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END) AS crc
  FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
          || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
        FROM documents)
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY source) AS n, coalesce('=' || source, '') AS tree
  FROM leaves
),
up AS (
  SELECT tree, 0 AS level, place, leaf AS node, n FROM numbered
  UNION ALL
  SELECT tree, level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)), (n + 2) // 3
  FROM up WHERE n > 1 GROUP BY tree, level, place // 3, n
),
subroots AS (SELECT tree, node AS subroot, level AS height FROM up WHERE n = 1),
trees AS (
  SELECT tree, subroot AS node, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM subroots
),
over_up AS (
  SELECT 0 AS level, place, node, n FROM trees
  UNION ALL
  SELECT level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)), (n + 2) // 3
  FROM over_up WHERE n > 1 GROUP BY level, place // 3, n
),
lanes AS (  -- the runs that a tree's nodes pass on their way to the root
  SELECT tree, level, place // 3 AS run, list(node ORDER BY place) AS nodes FROM up WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT tree, height + level, run, nodes FROM subroots,
    (SELECT level, place // 3 AS run, list(node ORDER BY place) AS nodes FROM over_up WHERE n > 1 GROUP BY ALL)
),
walk AS (
  SELECT d.tree, d.place AS id, 0 AS level, CASE WHEN height = 0 THEN t.place ELSE d.place END AS at,
         CASE WHEN crc % 2 = 1 THEN spoilt ELSE leaf END AS node, '' AS proof
  FROM numbered d JOIN subroots USING (tree) JOIN trees t USING (tree)
  UNION ALL
  SELECT w.tree, w.id, w.level + 1, CASE WHEN w.level + 1 = height THEN t.place ELSE w.at // 3 END,
         sha256(array_to_string(list_transform(l.nodes, lambda x, i: CASE WHEN i - 1 = w.at % 3 THEN w.node ELSE x END), '')),
         w.proof || array_to_string(list_filter(l.nodes, lambda x, i: i - 1 <> w.at % 3), '')
  FROM walk w JOIN subroots USING (tree) JOIN trees t USING (tree)
  JOIN lanes l ON l.tree = w.tree AND l.level = w.level AND l.run = w.at // 3
)
SELECT doc_id, leaf, subroot, o.node AS root, sha256(proof) AS proof_sha256, w.node AS folded_root, w.node = o.node AS verified
FROM numbered d JOIN subroots USING (tree) JOIN over_up o ON o.n = 1
JOIN walk w ON w.tree = d.tree AND w.id = d.place AND w.level = height + o.level
"""
