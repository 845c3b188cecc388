import itertools
import random

from pyspark.sql import functions as F

from samplyard.llm import urlrules as U

URLS = [
    "https://Sub.Example.org/es/x?y=1", "http://example.org/en/12", "http://badexample.org/en/1", "https://a.com/fr/1", "https://a.com/de/1",
    "https://a.com/DE/1", "org/none", "", None, "://", "x://org", "x://org/", "https://a.net?q#f", "https://a.net#f?q", "http://h/p/a.b?c://d/e",
    "https://example.org/es", "https://com/de/", "ftp://u@b.com:80/de/1",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    path = rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def fixed(host, path):
    best = None
    for verdict, rule in U.HOST_RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return best or (None, None)


def test_fixed_rules_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(URLS)], "page_id long, url string, html string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: r for r in U.judge_urls(pages, labels).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = parts(url)
        verdict, rule = fixed(host, path)
        assert tuple(got[i])[1:] == (host, path, rule, verdict or "allow"), url


def labelled(spark):
    rng = random.Random(2)
    pages, labels = [], []
    for i in range(600):
        host, lang, kind = rng.choice(["win", "news", "shop"]), rng.choice(["en", "it"]), rng.choice(["a", "b"])
        bad = (host == "win" and lang == "en") or kind == "b" and host == "shop" and rng.random() < 0.7
        pages.append((i, f"https://{host}.site{i % 3}.net/{lang}/{i}?{kind}=1", None))
        if i % 4:
            labels.append((i, 0 if bad else 1, 0))
    pages.append((None, None, None))
    labels += [(None, 0, 0), (5, None, 1), (99999, 0, 1)]
    return (
        spark.createDataFrame(pages, "page_id long, url string, html string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        pages,
        labels,
    )


def test_mined_rules_against_brute_force(spark):
    pages, labels, raw, marks = labelled(spark)
    tokens = {r["page_id"]: frozenset(r["t"]) for r in pages.select("page_id", U.url_tokens(F.col("url")).alias("t")).collect()}
    bad = {d: q == 0 for d, q, _ in marks if d is not None and q is not None and d in tokens}
    known = [(tokens[d], b) for d, b in bad.items()]
    least, sure = 0.01, 0.6
    rules = {}
    subsets = {frozenset(c) for t, b in known if b for n in range(1, len(t) + 1) for c in itertools.combinations(sorted(t), n)}
    for s in subsets:
        having = [b for t, b in known if s <= t]
        if sum(having) / len(known) >= least and sum(having) / len(having) >= sure:
            rules[s] = sum(having) / len(having)
    kept = {s for s, c in rules.items() if not any(rules.get(s - {x}, -1) >= c for x in s)}
    source = pages.select("page_id", U.url_tokens(F.col("url")).alias("tokens")).join(
        spark.createDataFrame(list(bad.items()), "page_id long, bad boolean"), "page_id"
    )
    got = {frozenset(r["tokens"]) for r in U.mine_rules(source, least, sure).collect()}
    assert got == kept and kept
    verdicts = {r["page_id"]: r["verdict"] for r in U.judge_urls(pages, labels, least, sure).collect()}
    for page_id, *_ in raw:
        hit = page_id is not None and any(s <= tokens[page_id] for s in kept)
        assert verdicts[page_id] == ("block" if hit else "allow")
    assert 0 < sum(v == "block" for v in verdicts.values()) < len(raw)


def test_empty_tables_and_clashing_columns(spark):
    pages, labels, raw, _ = labelled(spark)
    assert U.judge_urls(pages.limit(0), labels).count() == 0
    clash = pages.withColumns({c: F.lit("x") for c in ("tokens", "host", "verdict", "rule", "mined", "bad")})
    assert U.judge_urls(clash, labels.withColumn("page_id", F.lit("x"))).count() == len(raw)


def test_no_python_in_the_plan(spark):
    pages, labels, *_ = labelled(spark)
    plan = U.judge_urls(pages, labels)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Cartesian"))
