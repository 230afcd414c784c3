"""Language identification by interpolated Kneser-Ney character models.

A character is one of 64 symbols: no letter, a to z, or one of 37 classes of the other
letters (by code point).  Each language has a model of four-symbol grams with Kneser-Ney
discounts and continuation counts.  The grams seen in any language are held in one sorted
array with the log probability of each language beside them; what was never seen is
answered by the lower orders.  The alphabet bounds a model at 64**4 grams whatever the
corpus.  Grams are counted over the whole texts of all training rows.

The language with the lowest cross-entropy per symbol wins (ties: the first by name).  A
text whose cross-entropy is more than ``REJECT_DEVIATIONS`` standard deviations above the
mean of the training texts of that language is marked ``rejected``.  A null text, or one
without a letter, is ``und`` with score 0, as is every text when nothing was learned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from graphtide.llm.common import annotate, code_points, named, pieces, stored

BITS, ORDER, SYMBOLS = 6, 4, 64
REJECT_DEVIATIONS = 4.0
SCORE_SYMBOLS = 20  # the score is the posterior of a text of at most so many symbols
MERGE_AT = 4_000_000


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """Symbol of each code point; no letters are assigned above."""
    out = np.zeros(0x34000, np.uint8)
    for point in range(len(out)):
        letter = chr(point)
        if letter.isalpha():
            low = ord(letter.lower()[0])
            out[point] = low - 96 if 97 <= low <= 122 else 27 + low % 37
    return out


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grams in order, where those of each text begin, and which texts have a letter.

    A gram ends at each letter and at the first symbol after one.
    """
    points, first = code_points(texts)
    known = _symbols()
    symbol = known[np.where(points < len(known), points, 0)]
    letters = np.concatenate([[0], np.cumsum(symbol > 0)])
    rows = np.repeat(np.arange(len(texts)), np.diff(first))
    place = np.arange(len(symbol)) + (ORDER - 1) * (rows + 1)
    wide = np.zeros(len(symbol) + (ORDER - 1) * len(texts), np.uint32)
    wide[place] = symbol
    gram = wide[place]
    for back in range(1, ORDER):
        gram |= wide[place - back] << np.uint32(BITS * back)
    use = (symbol > 0) | (wide[place - 1] > 0)
    begin = np.concatenate([[0], np.cumsum(use)])
    return gram[use], begin[first], letters[first[1:]] > letters[first[:-1]]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    begin = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[begin], np.add.reduceat(counts, begin) if len(begin) else counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    sizes: dict[str, int] = {}
    for piece in pieces(batches, 1):
        gram, begin, _ = grams(piece.column(1))
        langs = np.array(piece.column(0).to_pylist(), object)
        for lang in set(langs):
            own = np.repeat(langs == lang, np.diff(begin))
            keys, counts = np.unique(np.sort(gram[own]).astype(np.int64), return_counts=True)
            held.setdefault(lang, []).append((keys, counts))
            sizes[lang] = sizes.get(lang, 0) + len(keys)
            if sizes[lang] > MERGE_AT:
                held[lang] = [_summed(*map(np.concatenate, zip(*held[lang])))]
                sizes[lang] = len(held[lang][0][0])
    for lang, parts in held.items():
        keys, counts = _summed(*map(np.concatenate, zip(*parts)))
        for a in range(0, len(keys), 100_000):
            n = len(keys[a : a + 100_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n), pa.array(keys[a : a + n], pa.int32()), pa.array(counts[a : a + n], pa.int64())], names=["lang", "gram", "n"])


def gram_counts(train: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """How often each language has each gram, over all training rows with a language."""
    rows = train.select(named(lang).cast("string").alias("lang"), named(text).cast("string").alias("text")).where("lang is not null and text is not null")
    return rows.mapInArrow(_count, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discount(counts: np.ndarray) -> float:
    once, twice = np.count_nonzero(counts == 1), np.count_nonzero(counts == 2)
    return once / (once + 2 * twice) if once and twice else 0.75


def _interpolated(counts: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of an order from its counts (context, symbol) and the order below; and the share left to the order below."""
    counts = counts.reshape(-1, SYMBOLS).astype(np.float64)
    off = _discount(counts)
    total = counts.sum(1, keepdims=True)
    left = np.where(total > 0, off * np.count_nonzero(counts, axis=1, keepdims=True) / np.maximum(total, 1), 1.0)
    own = np.maximum(counts - off, 0) / np.maximum(total, 1)
    below = np.tile(lower.reshape(-1, SYMBOLS), (len(counts) // (len(lower.ravel()) // SYMBOLS), 1))
    return own + left * below, left[:, 0]


class LanguageModel:
    """Sorted grams, the log probability of each by language, and the lower orders in full."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        self.langs = sorted(counts)
        self.grams = np.unique(np.concatenate([np.zeros(0, np.int64), *(k for k, _ in counts.values())])).astype(np.uint32)
        seen, below, left = [], [], []
        for lang in self.langs:
            keys, n = counts[lang]
            three = np.bincount(keys & 0x3FFFF, minlength=SYMBOLS**3)
            two = np.bincount(np.flatnonzero(three) & 0xFFF, minlength=SYMBOLS**2)
            one = np.bincount(np.flatnonzero(two) & 0x3F, minlength=SYMBOLS)
            p = np.full((1, SYMBOLS), 1 / SYMBOLS)
            for lower in (one, two, three):
                p, _ = _interpolated(lower, p)
            p3, off = p.ravel(), _discount(n)
            total = np.bincount(keys >> BITS, n, SYMBOLS**3)
            rest = np.where(total > 0, off * np.bincount(keys >> BITS, minlength=SYMBOLS**3) / np.maximum(total, 1), 1.0)
            own = np.zeros(len(self.grams))
            own[np.searchsorted(self.grams, keys)] = np.maximum(n - off, 0) / total[keys >> BITS]
            seen.append(np.log(own + rest[self.grams >> BITS] * p3[self.grams & 0x3FFFF]))
            below.append(np.log(p3))
            left.append(np.log(rest))
        shape = lambda x, n: np.stack(x, 1).astype(np.float32) if x else np.zeros((n, 0), np.float32)
        self.seen, self.below, self.left = shape(seen, 0), shape(below, SYMBOLS**3), shape(left, SYMBOLS**3)

    def index(self) -> np.ndarray:
        """Where each possible gram is among the sorted ones, -1 for none."""
        out = np.full(SYMBOLS**ORDER, -1, np.int32)
        out[self.grams] = np.arange(len(self.grams))
        return out


def learn(train: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Count on the cluster; the driver gets the gram counts, at most 64**4 for each language."""
    rows = gram_counts(train, text, lang).toArrow()
    langs = rows.column("lang").to_numpy(zero_copy_only=False) if rows.num_rows else np.zeros(0, object)
    keys, n = rows.column("gram").to_numpy().astype(np.int64), rows.column("n").to_numpy()
    counts = {}
    for value in sorted(set(langs)):
        own = langs == value
        order = np.argsort(keys[own])
        counts[value] = (keys[own][order], n[own][order])
    return LanguageModel(counts)


FIELDS = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("entropy", DoubleType())]


def _identify(shared) -> Callable[[pa.Array], list]:
    model: LanguageModel = shared.value
    index, names = model.index(), np.array([*model.langs, "und"], object)

    def columns(texts: pa.Array) -> list[pa.Array]:
        gram, begin, lettered = grams(texts)
        n = np.diff(begin)
        where = index[gram]
        new = np.flatnonzero(where < 0)
        entropy = np.zeros((len(texts), len(model.langs)))
        for k in range(len(model.langs)):
            log_p = model.seen[where, k] if len(model.seen) else np.zeros(len(gram), np.float32)
            log_p[new] = model.left[gram[new] >> BITS, k] + model.below[gram[new] & 0x3FFFF, k]
            total = np.concatenate([[0], np.cumsum(log_p, dtype=np.float64)])
            entropy[:, k] = -(total[begin[1:]] - total[begin[:-1]]) / np.maximum(n, 1)
        if not model.langs:
            none = len(texts)
            return [pa.array(["und"] * none), pa.array(np.zeros(none)), pa.array([None] * none, pa.float64())]
        best = entropy.argmin(1)
        low = entropy[np.arange(len(texts)), best]
        score = 1 / np.exp(-(entropy - low[:, None]) * np.minimum(n, SCORE_SYMBOLS)[:, None]).sum(1)
        return [
            pa.array(names[np.where(lettered, best, len(model.langs))], pa.string()), pa.array(np.where(lettered, score, 0.0)),
            pa.array(low, mask=~lettered),
        ]

    return columns


def identify(docs: DataFrame, model: LanguageModel, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Documents with ``lang_pred``, ``score`` (0 to 1) and ``entropy`` (nats per symbol)."""
    return annotate(docs, text, FIELDS, partial(_identify, docs.sparkSession.sparkContext.broadcast(model)), keep)


def reject(identified: DataFrame, trusted: Column) -> DataFrame:
    """Add ``rejected``; ``trusted`` marks the training rows whose language was found right."""
    limit = F.avg("entropy") + REJECT_DEVIATIONS * F.coalesce(F.stddev_pop("entropy"), F.lit(0.0))
    limits = identified.where(trusted).groupBy("lang_pred").agg(limit.alias("␟limit"))  # a row for each language of the model
    joined = identified.join(F.broadcast(limits), "lang_pred", "left")
    return joined.withColumn("rejected", F.coalesce(F.col("entropy") > F.col("␟limit"), F.lit(True))).drop("␟limit")


def label_languages(docs: DataFrame, train: Column, *, text: str = "text", lang: str = "lang", keep: list[str]) -> DataFrame:
    """Learn from the rows ``train``, identify all, and mark rejections; ``keep`` names the columns to return."""
    rows = docs.withColumn("␟lang", F.when(train, named(lang).cast("string")))
    model = learn(rows, text, "␟lang")
    found = stored(identify(rows, model, text=text, keep=[*keep, "␟lang"]), "languages")
    return reject(found, F.col("␟lang") == F.col("lang_pred")).drop("␟lang")
