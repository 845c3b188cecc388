"""URL filter: fixed host and path rules first, then association rules mined from labelled URLs.

A URL becomes a set of tokens (scheme, host parts, path parts with digits masked, query keys).
FP-growth finds the token sets that go with the bad label; rules below the wanted support or
confidence, and rules that a shorter rule of no less confidence covers, are pruned. Rules are
matched through an inverted index: each rule stands under its rarest token, a URL looks up its
tokens and keeps the rules all of whose tokens it has.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, rule): a host with all its subdomains, then the beginning of the path.
HOST_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
BAD = "label:bad"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules=HOST_RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        cut = text.index("/")
        fits = (F.concat(F.lit("."), host).endswith("." + text[:cut])) & path.startswith(text[cut:])
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL; none for null and for text without ``://``."""
    host, path = host_and_path(url)
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)

    def tagged(tag: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))

    masked = F.regexp_replace(path, "[0-9]+", "0")
    every = F.concat(
        F.array(F.concat(F.lit("scheme:"), F.lower(F.substring_index(url, "://", 1)))),
        F.array(F.concat(F.lit("site:"), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1))),
        tagged("host:", F.split(host, r"\.")),
        tagged("path:", F.split(masked, r"[/.]")),
        tagged("query:", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))),
        F.when(F.instr(url, "#") > 0, F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
    )
    return F.when(F.instr(url, "://") > 0, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def mine_rules(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.5) -> DataFrame:
    """``tokens, confidence, support, rarest`` of each rule "these tokens, then bad".

    ``labelled``: ``tokens`` and ``bad`` (boolean; null rows are left out). With no rows, no rules.
    ``min_support`` is the share of labelled URLs that have all tokens and the bad label; it bounds
    the number of rules, since a URL has few tokens.
    """
    known = labelled.filter("bad IS NOT NULL AND size(tokens) > 0")
    items = known.select(F.when(F.col("bad"), F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = (
        model.associationRules.filter((F.size("consequent") == 1) & (F.element_at("consequent", 1) == BAD))
        .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
        .filter((F.col("confidence") >= min_confidence) & (F.col("support") >= min_support))
    )
    # A rule goes if dropping one of its tokens leaves a rule of no less confidence.
    parts = rules.select("tokens", "confidence", F.explode("tokens").alias("token")).filter(F.size("tokens") > 1)
    shorter = parts.select("tokens", "confidence", F.array_remove("tokens", F.col("token")).alias("part"))
    covered = (
        shorter.join(rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("part_confidence")), "part")
        .filter("part_confidence >= confidence")
        .select("tokens")
        .distinct()
    )
    kept = rules.join(covered, "tokens", "left_anti")
    seen = known.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    rarest = (
        kept.select("tokens", F.explode("tokens").alias("token"))
        .join(seen, "token")
        .groupBy("tokens")
        .agg(F.min(F.struct("n", "token"))["token"].alias("rarest"))
    )
    return kept.join(rarest, "tokens")


def matching_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``url`` of those that some rule matches."""
    index = rules.select(F.col("tokens").alias("rule_tokens"), F.col("rarest").alias("token"))
    found = urls.select("url", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    return found.filter(F.size(F.array_except("rule_tokens", "tokens")) == 0).select("url").distinct()


def judge_urls(pages: DataFrame, labels: DataFrame, min_support: float = 0.002, min_confidence: float = 0.5) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``.

    ``labels`` marks a page by ``doc_id`` = page_id: bad if a row has quality 0; rows with null are
    left out. A null or empty URL has no tokens, so no mined rule matches it: allow.
    """
    host, path = host_and_path(F.col("url"))
    rule, fixed = fixed_rule(host, path)
    marked = labels.filter("quality IS NOT NULL").groupBy(F.col("doc_id").alias("page_id")).agg(F.max(F.col("quality") == 0).alias("bad"))
    labelled = pages.select("page_id", url_tokens(F.col("url")).alias("tokens")).join(marked, "page_id")
    rules = mine_rules(labelled, min_support, min_confidence)
    # Only URLs that no fixed rule settles are looked up, each once.
    open_urls = pages.filter(fixed.isNull() & F.col("url").isNotNull()).select("url").distinct()
    blocked = matching_urls(open_urls.select("url", url_tokens(F.col("url")).alias("tokens")), rules)
    blocked = blocked.select("url", F.lit("block").alias("mined"))
    return pages.select("page_id", "url").join(blocked, "url", "left").select(
        "page_id",
        host.alias("host"),
        path.alias("path"),
        rule.alias("rule"),
        F.coalesce(fixed, F.col("mined"), F.lit("allow")).alias("verdict"),
    )
