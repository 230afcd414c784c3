import math
import random
import re

from pyspark.sql import functions as F

from graphtide.llm.queries import RULES
from graphtide.llm.url_filter import ALPHABET, LEAST_CONTEXT, ORDER, SIGNS, differences, filter_urls, learn

URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com/en/1", "http://m.example.com/en/1", "http://example.com/en",
    "http://notexample.com/en/", "https://a.net/es/1", "https://net/fr/", "http://a.com", "http://a.com?x/y", "http://a.com/#/", "x://y://z.com/", "http://é.org/ß", "http://a.org/\n/b",
]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for r in RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (best is None or len(r.text) > len(best.text)):
            best = r
    return host, path, best.text if best else None, best.verdict if best else None


def test_rules(spark):
    pages = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(URLS + URLS)], "page_id long, url string, host string, accepted string")
    rows = filter_urls(pages, RULES, keep=["page_id"]).collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        want = brute((URLS + URLS)[r.page_id])
        assert (r.host, r.path, r.rule) == want[:3] and r.verdict in ("allow", "block")
        assert want[3] is None or r.verdict == want[3]
    assert filter_urls(pages.where("false"), RULES, keep=["page_id"]).count() == 0
    # Without rules nothing can be learned: all are allowed.
    assert {r.verdict for r in filter_urls(pages, [], keep=["page_id"]).collect()} == {"allow"}


def signs(url):
    rest = url.split("://", 1)[1]
    return [SIGNS - 1] * ORDER + [ALPHABET.index(c) + 1 if c in ALPHABET else 0 for c in re.sub("[0-9]", "0", rest).lower()]


def test_model_against_definition(spark):
    random.seed(6)
    urls = [("http://" + "".join(random.choice("ab/1.Z~") for _ in range(random.randrange(1, 15))), random.random() < 0.5) for _ in range(60)]
    df = spark.createDataFrame(urls, "url string, accepted boolean")
    model = learn(df, df)
    got = {r.url: r.difference for r in differences(df.select("url").distinct(), model, "url", []).collect()}
    counts = {True: {}, False: {}}
    for url, kind in urls:
        s = signs(url)
        for i in range(ORDER, len(s)):
            for k in range(ORDER + 1):
                context = counts[kind].setdefault(tuple(s[i - k:i]), {})
                context[s[i]] = context.get(s[i], 0) + 1

    def p(kind, s, i):
        likely = 1 / SIGNS
        for k in range(ORDER + 1):
            context = counts[kind].get(tuple(s[i - k:i]), {})
            n, t = sum(context.values()), len(context)
            if n >= (LEAST_CONTEXT if k else 1):
                likely = (context.get(s[i], 0) + t * likely) / (n + t)
        return likely

    for url, _ in urls:
        s = signs(url)
        ratios = [math.log(p(True, s, i) / p(False, s, i)) for i in range(ORDER, len(s))]
        assert abs(got[url] - sum(ratios) / len(ratios)) < 1e-9


def test_learned_verdicts_follow_the_rules_examples(spark):
    pages = spark.range(800).select("id", F.concat(F.lit("http://h"), F.pmod("id", F.lit(5)).cast("string"), F.when(F.col("id") % 2 == 0, ".com/shop/").otherwise(".net/es/casino/"), F.col("id").cast("string")).alias("url"))
    more = spark.createDataFrame([(9001, "http://k.org/shop/7"), (9002, "http://k.org/es/casino/7")], "id long, url string")
    got = {r.id: r.verdict for r in filter_urls(pages.union(more), RULES, keep=["id"]).where("rule is null").collect()}
    assert got == {9001: "allow", 9002: "block"}
