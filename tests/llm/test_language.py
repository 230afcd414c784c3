import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from graphtide.llm.language import LanguageModel, grams, label_languages


def counts(texts):
    keys, n = np.unique(grams(pa.array(texts, pa.string()))[0], return_counts=True)
    return keys.astype(np.int64), n


def test_probabilities_of_every_context_sum_to_one():
    random.seed(1)
    texts = ["".join(random.choice("abc é") for _ in range(300)) for _ in range(3)]
    model = LanguageModel({"x": counts(texts), "y": counts(["abab cab"])})
    assert np.allclose(np.exp(model.below.astype(float)).reshape(-1, 64, 2).sum(1), 1, atol=1e-4)
    for k in range(2):
        for context in {int(g) >> 6 for g in model.grams}:
            p = 0.0
            for symbol in range(64):
                gram = context << 6 | symbol
                at = np.searchsorted(model.grams, gram)
                seen = at < len(model.grams) and model.grams[at] == gram
                p += math.exp(model.seen[at, k] if seen else model.left[context, k] + model.below[gram & 0x3FFFF, k])
            assert abs(p - 1) < 1e-4


def test_kneser_ney_against_definition():
    keys, n = counts(["ab ab abc", "b ab"])
    model = LanguageModel({"x": (keys, n)})
    table = dict(zip(keys.tolist(), n.tolist()))

    def discount(values):
        once, twice = sum(v == 1 for v in values), sum(v == 2 for v in values)
        return once / (once + 2 * twice) if once and twice else 0.75

    levels = [table]
    for size in (3, 2, 1):
        lower = {}
        for g in levels[-1]:
            lower[g & (64**size - 1)] = lower.get(g & (64**size - 1), 0) + 1
        levels.append(lower)
    levels = levels[::-1]

    def p(gram, order):
        if order < 0:
            return 1 / 64
        level, context = levels[order], gram >> 6
        d = discount(list(level.values()))
        mine = {g: c for g, c in level.items() if g >> 6 == context}
        below = p(gram & (64**order - 1), order - 1)
        if not mine:
            return below
        total = sum(mine.values())
        return max(mine.get(gram, 0) - d, 0) / total + d * len(mine) / total * below

    for k, g in enumerate(model.grams.tolist()):
        assert abs(math.exp(model.seen[k, 0]) - p(g, 3)) < 1e-5


def test_rows(spark, documents):
    en = ["the cat and the dog are on the mat with the others"] * 3
    de = ["der hund und die katze sind auf der matte mit den anderen"] * 3
    rows = [(k, t, "en") for k, t in enumerate(en)] + [(k + 10, t, "de") for k, t in enumerate(de)]
    rows += [(20, None, "en"), (21, "", None), (22, "12 .. 34", "de"), (23, "und die katze", None), (24, "the dog " * 30_000, None), (24, "the dog", None)]
    got = {r.doc_id: r for r in label_languages(documents(rows), F.col("doc_id") < 20, keep=["doc_id", "score"]).collect()}
    assert [got[i].lang_pred for i in (20, 21, 22, 23, 24)] == ["und", "und", "und", "de", "en"]
    assert all(0 <= r.score <= 1 for r in got.values()) and got[20].score == 0
    nothing = label_languages(documents(rows), F.lit(False), keep=["doc_id"]).collect()
    assert {r.lang_pred for r in nothing} == {"und"} and len(nothing) == len(rows)
    assert label_languages(documents(rows).where("false"), F.lit(True), keep=["doc_id"]).count() == 0
