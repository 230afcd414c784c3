"""Quality rules by distribution divergence.

A text has two histograms: its characters by class (lower, upper, digit, stop, sign,
blank, other) and its words by a list of common words of the known languages (all others
together).  The references are the sums of both over the texts of a language that pass
the base rules.  A text is kept if for some language the Jensen-Shannon distances (base 2,
square root of the divergence) of both histograms are within the limits: ``CHAR_LIMIT``,
and ``WORD_SHARE`` of the distance of a text that has no common word at all.  Histograms
of few counts say little, so fewer than ``LEAST_CHARS`` characters or ``LEAST_WORDS``
words leave the limit out.

Everything is built-in expressions; a text never leaves its row.  Repeated three-word
windows are found by sorting their 64-bit hashes, with the position in the low bits.
The references are a row for each language of ``COMMON_WORDS`` and histogram entry.

A text whose ``lang`` has no reference (a language without a list of common words) is not held
to the word limit.  A null text is an empty one and fails the base rules.  Without a
reference (no row of a known language) the base rules decide.  Columns of the results' names
are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphtide.llm.common import named, stored

# Frequent function words of each language.
COMMON_WORDS: dict[str, list[str]] = {
    "en": "the of and to in a is that for it as was with be by on not he this are or at from which have an had they you were".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er hat aus bei nach wird".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha".split(),
}
CHAR_LIMIT, WORD_SHARE = 0.30, 0.97
LEAST_CHARS, LEAST_WORDS = 200, 50
BASE_WORDS = 50
BASE_REPEATED = 50  # per cent

RESULTS = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept"}
BLANK = r"[\x20\x09-\x0D]+"
CLASSES = {"lower": r"\p{Ll}+", "upper": r"\p{Lu}+", "digit": r"[0-9]+", "stop": r"[.,;:'\"!?()\-]+", "sign": r"[#*$%&|<>]+"}


def _without(text: str, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def _repeated(hashes: str, n: str) -> Column:
    """Words in three-word windows that occur twice or more, from the words' hashes."""
    windows = F.slice(F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2))), 1, F.greatest(F.col(n) - 2, F.lit(0)))

    def count(windows: Column, mask: Column) -> Column:
        packed = F.sort_array(F.transform(windows, lambda h, i: h.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("bigint"))))

        def places(packed: Column) -> Column:
            whole = lambda x: F.get(windows, x.bitwiseAND(mask).cast("int"))
            same = lambda x, j: F.coalesce(whole(x) == whole(F.get(packed, j)), F.lit(False))
            again = F.filter(packed, lambda x, j: same(x, j - 1) | same(x, j + 1))
            return F.sort_array(F.transform(again, lambda x: x.bitwiseAND(mask)))

        def covered(at: Column) -> Column:
            steps = F.transform(at, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - p, F.lit(3)).cast("int")))
            return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

        return _let(_let(packed, places), covered)

    mask = F.pow(F.lit(2.0), F.ceil(F.log2(F.col(n) + 1))).cast("bigint") - 1
    # Most texts repeat no window; only the others are sorted.
    return _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")).otherwise(count(w, mask)))


def _let(value: Column, body) -> Column:
    """``body`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _slots(docs: DataFrame) -> tuple[int, list[int], list[int]]:
    """A table of the common words by hash: its size, the hashes and the words' numbers."""
    words = sorted({w for group in COMMON_WORDS.values() for w in group})
    hashes = docs.sparkSession.range(1).select(F.array(*[F.xxhash64(F.lit(w)) for w in words])).head()[0]
    size = next(n for n in range(4 * len(words), 1 << 20) if len({h % n for h in hashes}) == len(words))
    held, number = [0] * size, [-1] * size
    for k, h in enumerate(hashes):
        held[h % size], number[h % size] = h, k
    return size, held, number


def measure(docs: DataFrame, *, text: str = "text", keep: list[str]) -> DataFrame:
    """The base measures and both histograms: ``chars`` by class, ``common`` as (number of the word, count)."""
    kept = [named(c) for c in keep]
    df = docs.select(*kept, F.coalesce(named(text).cast("string"), F.lit("")).alias("␟x"))
    n = F.length("␟x")
    df = df.select(
        *kept, n.alias("␟n"), F.filter(F.split("␟x", BLANK), lambda w: w != "").alias("␟words"), _without("␟x", BLANK).alias("word_chars"),
        *[(n - _without("␟x", p)).alias(f"␟{c}") for c, p in CLASSES.items()],
        F.filter(F.split("␟x", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("␟lines"))
    df = df.select(
        *kept, F.size("␟words").cast("bigint").alias("n_words"), F.col("word_chars").cast("bigint").alias("word_chars"), F.col("␟sign").cast("bigint").alias("n_symbols"),
        (F.size("␟lines") - F.size(F.array_distinct("␟lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("␟words", lambda w: F.xxhash64(w)).alias("␟hashes"),
        F.array(*[F.col(f"␟{c}") for c in CLASSES], F.col("␟n") - F.col("word_chars"), F.col("word_chars") - sum((F.col(f"␟{c}") for c in CLASSES), F.lit(0))).alias("chars"))

    size, held, number = _slots(docs)
    table, numbers = F.lit(held), F.lit(number)
    at = lambda h: F.pmod(h, F.lit(size)).cast("int")
    known = F.filter(F.transform("␟hashes", lambda h: F.when(F.get(table, at(h)) == h, F.get(numbers, at(h)))), lambda k: k.isNotNull())

    def runs(sorted_: Column) -> Column:
        last = F.filter(F.transform(sorted_, lambda v, i: F.when(F.coalesce(F.get(sorted_, i + 1) != v, F.lit(True)), F.struct(v.alias("word"), (i + 1).alias("end")))), lambda e: e.isNotNull())
        return _let(last, lambda e: F.transform(e, lambda x, i: F.struct(x["word"].alias("word"), (x["end"] - F.coalesce(F.get(e, i - 1)["end"], F.lit(0))).alias("n"))))

    df = df.select("*", _repeated("␟hashes", "n_words").alias("n_repeat_words"), _let(F.array_sort(known), runs).alias("common")).drop("␟hashes")
    failed = (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > BASE_REPEATED * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def references(measured: DataFrame, lang: str) -> dict[str, tuple[list[float], dict[int, float]]]:
    """For each known language its share of each character class and of each common word (-1: all other words)."""
    good = measured.where(~F.col("base_failed") & named(lang).isin(*COMMON_WORDS))
    common = F.transform("common", lambda x: F.struct((x["word"] + 100).alias("entry"), x["n"].cast("bigint").alias("n")))
    classes = F.transform("chars", lambda n, i: F.struct(i.alias("entry"), n.cast("bigint").alias("n")))
    rows = good.select(named(lang).alias("lang"), F.explode(F.concat(classes, common, F.array(F.struct(F.lit(-1).alias("entry"), F.col("n_words").alias("n"))))).alias("e"))
    out: dict[str, dict[int, float]] = {}
    for row in rows.groupBy("lang", "e.entry").agg(F.sum("e.n").alias("n")).collect():
        out.setdefault(row["lang"], {})[row["entry"]] = float(row["n"])
    result = {}
    for name, sums in sorted(out.items()):
        chars = [sums.get(i, 0.0) for i in range(len(CLASSES) + 2)]
        words = {k - 100: v / sums[-1] for k, v in sums.items() if k >= 100}
        result[name] = ([c / sum(chars) for c in chars], words | {-1: 1 - sum(words.values())})
    return result


def _half(p: Column, q: Column) -> Column:
    """p log2(p / m) with m the mean of p and q."""
    return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)


def _distance(divergence: Column) -> Column:
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def _char_distance(reference: list[float]) -> Column:
    total = F.greatest(F.aggregate("chars", F.lit(0), lambda a, x: a + x), F.lit(1))
    q = F.lit(reference)
    parts = F.transform("chars", lambda n, i: _half(n / total, F.get(q, i)) + _half(F.get(q, i), n / total))
    return _distance(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2)


def _word_distance(reference: dict[int, float], words: int) -> Column:
    # A word that the text lacks adds half its reference share.
    q = F.lit([reference.get(k, 0.0) for k in range(words)])
    n = F.greatest(F.col("n_words"), F.lit(1))
    term = lambda p, q: (_half(p, q) + _half(q, p) - q) / 2
    listed = F.aggregate("common", F.lit(0.0), lambda a, x: a + term(x["n"] / n, F.get(q, x["word"])))
    other = 1 - F.aggregate("common", F.lit(0), lambda a, x: a + x["n"]) / n
    return _distance(F.lit(0.5) + listed + term(other, F.lit(reference[-1])))


def judge(measured: DataFrame, known: dict[str, tuple[list[float], dict[int, float]]], lang: str | None = None) -> DataFrame:
    """Add ``char_distance`` and ``word_distance`` to the nearest language, and ``kept``.

    ``lang`` names the column of the language that a text is said to be in.
    """
    words = len({w for group in COMMON_WORDS.values() for w in group})

    def limit(reference: dict[int, float]) -> float:
        """The share of the distance of a text without any common word."""
        other = reference[-1]
        none = 0.5 + ((math.log2(2 / (1 + other)) + (other * math.log2(2 * other / (1 + other)) if other else 0.0) - other) / 2)
        return WORD_SHARE * math.sqrt(max(none, 0.0))

    if not known:
        nothing = F.lit(None).cast("double")
        return measured.withColumns({"char_distance": nothing, "word_distance": nothing, "kept": ~F.col("base_failed")})
    each = F.array(*[F.struct(_word_distance(w, words).alias("word"), _char_distance(c).alias("char"), F.lit(limit(w)).alias("limit")) for c, w in known.values()])
    judged = measured.withColumn("␟each", each)
    foreign = F.coalesce(~named(lang).isin(*known), F.lit(False)) if lang else F.lit(False)
    fits = lambda d: ((d["char"] <= CHAR_LIMIT) | (F.aggregate("chars", F.lit(0), lambda a, x: a + x) < LEAST_CHARS)) & ((d["word"] <= d["limit"]) | (F.col("n_words") < LEAST_WORDS) | foreign)
    best = F.array_min("␟each")
    return judged.withColumns({"char_distance": best["char"], "word_distance": best["word"], "kept": ~F.col("base_failed") & F.exists("␟each", fits)}).drop("␟each")


def apply_rules(docs: DataFrame, *, text: str = "text", lang: str = "lang", keep: list[str]) -> DataFrame:
    """Measures, distances and ``kept`` of each document; ``keep`` names the columns to return with them."""
    kept = {f"␟own-{i}": c for i, c in enumerate(keep) if c.lower() not in RESULTS}
    source = docs.select(*[named(c).alias(own) for own, c in kept.items()], named(text).alias("␟text"), named(lang).cast("string").alias("␟lang"))
    measured = stored(measure(source, text="␟text", keep=[*kept, "␟lang"]), "divergence")
    judged = judge(measured, references(measured, "␟lang"), "␟lang").drop("␟lang", "chars", "common")
    return judged.select(*[F.col(c).alias(kept[c]) if c in kept else c for c in judged.columns])
