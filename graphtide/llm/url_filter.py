"""URL filter: rules for hosts and paths, and for all other URLs a ratio of character models.

Rules allow or block a host with its subdomains and the paths that start alike; the
longest rule decides.  The URLs that rules judge are the accepted and the rejected
examples of two variable-order Markov models over the characters of the URL behind
``://`` (digits as one sign, at most ``ORDER`` characters of context).  A context that a
model has seen fewer than ``LEAST_CONTEXT`` times is not used; each order is smoothed
with the one below (Witten-Bell) down to equal shares.  A URL without a rule is allowed if
the log-likelihood difference for each character is at least the threshold that best
separates the examples of the calibration fold, which the models have not seen.

All is built-in expressions: grams are counted over the exploded URLs and shrink before
the shuffle.  The alphabet bounds the model at ``SIGNS ** (ORDER + 1)`` rows of 16 bytes
(37 MB), which is the proven bound of the broadcast.

A null URL, or one without ``://``, has an empty host and path, fits no rule and is scored
as the empty string: difference 0.  If one kind of example is missing, the threshold is 0
and all differences are 0, so what no rule judges is allowed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from graphtide.llm.common import named, stored

ALPHABET = "abcdefghijklmnopqrstuvwxyz0/.-_:?=&#%"
SIGNS = len(ALPHABET) + 2  # one for all others, one for the place before the URL
ORDER = 3
LEAST_CONTEXT = 2
FOLDS = 5  # one of them calibrates
BIN = 0.01  # of the calibration histogram, whose differences are within +-LIMIT
LIMIT = 20.0


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def rule_columns(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    fits = [((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)) for r in ordered]
    pick = lambda value: F.coalesce(*[F.when(f, F.lit(value(r))) for f, r in zip(fits, ordered)], F.lit(None).cast("string"))
    return pick(lambda r: r.text), pick(lambda r: r.verdict)


def _grams(urls: DataFrame, keep: list[str]) -> DataFrame:
    """A row for each character of ``url``: the sign and the ``ORDER`` before it as one number."""
    rest = F.lower(F.regexp_replace(F.coalesce(F.regexp_extract("url", r"(?s)://(.*)$", 1), F.lit("")), "[0-9]", "0"))
    signs = F.transform(F.split(rest, ""), lambda c: F.instr(F.lit(ALPHABET), c))  # 0: another sign
    signs = F.when(F.length(rest) == 0, F.array().cast("array<int>")).otherwise(signs)
    before = F.array_repeat(F.lit(SIGNS - 1), ORDER)
    padded = urls.select(*keep, F.concat(before, signs).alias("s"))
    number = lambda i: reduce(lambda a, k: a * SIGNS + F.get("s", i + k), range(1, ORDER + 1), F.get("s", i).cast("bigint"))
    grams = F.transform(F.slice("s", 1, F.size("s") - ORDER), lambda _, i: number(i))
    return padded.select(*keep, F.explode(grams).alias("gram"))


def learn(urls: DataFrame, every: DataFrame) -> DataFrame:
    """(gram, ratio): log-likelihood difference of each gram of ``every``; ``urls`` has (url, accepted)."""
    counts = _grams(urls, ["accepted"]).groupBy("gram").agg(*[F.sum((F.col("accepted") == v).cast("bigint")).alias(n) for v, n in ((True, "a"), (False, "r"))])
    seen = _grams(every, []).select("gram").distinct()
    grams = stored(seen.join(counts, "gram", "left").select("gram", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("r", F.lit(0)).alias("r")), "url-grams")
    likely = {"a": F.lit(1.0 / SIGNS), "r": F.lit(1.0 / SIGNS)}
    out = grams
    for order in range(ORDER + 1):
        pair, context = F.col("gram") % SIGNS ** (order + 1), F.floor(F.col("gram") % SIGNS ** (order + 1) / SIGNS)
        pairs = grams.groupBy(pair.alias(f"pair{order}")).agg(F.sum("a").alias("pa"), F.sum("r").alias("pr"))
        contexts = pairs.groupBy(F.floor(F.col(f"pair{order}") / SIGNS).alias(f"context{order}")).agg(
            *[f(c).alias(n) for k in "ar" for f, c, n in ((F.sum, f"p{k}", f"n{k}"), (F.count_if, F.col(f"p{k}") > 0, f"t{k}"))])
        out = out.withColumns({f"pair{order}": pair, f"context{order}": context}).join(pairs, f"pair{order}").join(contexts, f"context{order}")
        made = {}
        for k in "ar":
            n, t = F.col(f"n{k}"), F.col(f"t{k}")
            made[f"p{order}{k}"] = F.when(n >= (LEAST_CONTEXT if order else 1), (F.col(f"p{k}") + t * likely[k]) / (n + t)).otherwise(likely[k])
        out = out.withColumns(made).drop("pa", "pr", "na", "nr", "ta", "tr", f"pair{order}", f"context{order}")
        likely = {k: F.col(f"p{order}{k}") for k in "ar"}
    return stored(out.select("gram", F.log(likely["a"] / likely["r"]).alias("ratio")), "url-model")


def differences(urls: DataFrame, model: DataFrame, key: str, keep: list[str]) -> DataFrame:
    """``difference`` of each URL: the mean ratio of its characters; (key, kept columns, difference)."""
    return _grams(urls, [key, *keep]).join(F.broadcast(model), "gram").groupBy(key, *keep).agg(F.avg("ratio").alias("difference"))


def threshold(scored: DataFrame) -> float:
    """The difference that best separates accepted from rejected URLs (balanced), in the middle of the gap around it."""
    place = F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.col("difference"))) / BIN)
    bins = scored.groupBy(place.alias("bin")).agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r"))  # 4001 rows at most
    rows = sorted((r["bin"], r["a"], r["r"]) for r in bins.collect())
    accepted, rejected = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not accepted or not rejected:
        return 0.0
    best, below_a, below_r, before = [], 0, 0, rows[0][0] - 1
    for at, a, r in [*rows, (rows[-1][0] + 1, 0, 0)]:
        best.append((below_r / rejected - below_a / accepted, (before + 1 + at) / 2))
        below_a, below_r, before = below_a + a, below_r + r, at
    top = max(b for b, _ in best)
    ties = [at for b, at in best if b > top - 1e-12]
    return ties[len(ties) // 2] * BIN


def filter_urls(pages: DataFrame, rules: list[Rule], *, url: str = "url", keep: list[str]) -> DataFrame:
    """``host``, ``path``, ``rule``, ``verdict`` and ``difference`` (null where a rule decides) with the columns ``keep``.

    URLs repeat, so each distinct one is scored once; a row is then joined by its URL.
    """
    source = pages.select(*[named(c) for c in keep], named(url).cast("string").alias("␟url"))
    text = F.coalesce("␟url", F.lit(""))
    host, path = host_and_path(F.col("␟url"))
    judged = source.select("*", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    judged = judged.select("*", rule.alias("rule"), verdict.alias("␟verdict"))

    distinct = stored(judged.groupBy(text.alias("url")).agg(F.first("␟verdict").alias("verdict")), "urls")
    examples = distinct.where("verdict is not null").select("url", (F.col("verdict") == "allow").alias("accepted"), (F.pmod(F.crc32("url"), F.lit(FOLDS)) == 0).alias("calibrates"))
    model = learn(examples.where("not calibrates"), distinct.select("url"))
    limit = threshold(differences(examples.where("calibrates"), model, "url", ["accepted"]))
    free = differences(distinct.where("verdict is null").select("url"), model, "url", []).withColumnRenamed("url", "␟text")
    # Rows that a rule judges stay out of the join: they would all meet under one key.
    ruled = judged.where("`␟verdict` is not null").withColumn("difference", F.lit(None).cast("double"))
    others = judged.where("`␟verdict` is null").withColumn("␟text", text).join(free, "␟text", "left").drop("␟text")
    learned = F.when(F.coalesce("difference", F.lit(0.0)) >= limit, "allow").otherwise("block")
    joined = ruled.unionByName(others)
    return joined.select(*[named(c) for c in keep], "host", "path", "rule", F.coalesce("␟verdict", learned).alias("verdict"), "difference")
