import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from graphtide.llm import quality, toxicity
from graphtide.llm.learning import Logistic
from graphtide.llm.quality import minimise_risk

BASE = "/root/testdata/sf0.01"


def test_logistic_recovers_weights():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 2)) * [1, 5] + [0, 3]
    p = 1 / (1 + np.exp(-(2 * x[:, 0] - 0.4 * x[:, 1])))
    fit = Logistic.fit(x, (rng.random(4000) < p).astype(int))
    assert np.abs(fit(x) - p).mean() < 0.02


def plain_risk(x, weights, mean, scale):
    """Mean of log(1 + exp(f)) and its gradient, text by text."""
    loss, slope = 0.0, [0.0] * len(weights)
    for row in x:
        z = [(v - m) / s for v, m, s in zip(row, mean, scale)] + [1.0]
        f = sum(a * b for a, b in zip(z, weights))
        loss += math.log1p(math.exp(f))
        slope = [a + b / (1 + math.exp(-f)) for a, b in zip(slope, z)]
    return loss / len(x), [a / len(x) for a in slope]


def test_risk_separates_without_negative_labels():
    rng = np.random.default_rng(1)
    positive = rng.normal(1.5, 1, (600, 5))
    truth = rng.random(2000) < 0.7
    unlabelled = np.where(truth[:, None], rng.normal(1.5, 1, (2000, 5)), rng.normal(-1.5, 1, (2000, 5)))
    mean, scale = unlabelled.mean(0), unlabelled.std(0)
    seen = []

    def over_all(w):
        seen.append(plain_risk(unlabelled, w, mean, scale))
        return seen[-1][0], np.array(seen[-1][1])

    model = minimise_risk(positive, unlabelled[::10], 0.7, mean, scale, over_all)
    assert ((model.margin(unlabelled) > 0) == truth).mean() > 0.97

    def whole(w):
        f = np.c_[(positive - mean) / scale, np.ones(600)] @ w
        return 0.7 * np.logaddexp(0, -f).mean() + max(0, plain_risk(unlabelled, w, mean, scale)[0] - 0.7 * np.logaddexp(0, f).mean()) + quality.RIDGE / 2 * w @ w

    least = whole(model.weights)
    assert all(whole(model.weights + d) > least - 1e-4 for d in rng.normal(0, 0.1, (40, 6)))


def test_unlabelled_sums_match_a_plain_loop(spark):
    texts = ["", None, "One two, three.", "one one one", "ÄÖ 12 #!", "line\nline\n" * 9] * 5
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id long, text string").repartition(7)
    x = np.array(quality.features(pa.array(texts)).astype(np.float16), float)
    every = quality.Unlabelled(quality.annotate(df, "text", [quality.StructField("f", quality.BinaryType())], quality._packed, []))
    assert every.n == len(texts)
    assert np.allclose(every.mean, x.mean(0)) and np.allclose(every.scale, x.std(0) + 0.01)
    weights = np.random.default_rng(3).normal(0, 0.05, quality.WIDTH + 1)
    loss, slope = every.risk(weights)
    plain = plain_risk(x, weights, every.mean, every.scale)
    assert abs(loss - plain[0]) < 1e-9 and np.allclose(slope, plain[1])
    score = Logistic.fit(x, np.arange(len(x)) % 2)
    bounds = np.array([0.2, 0.5, 0.5000001, 0.8])
    assert every.histogram(score, bounds).tolist() == [int(((score(x) >= a) & (score(x) < b)).sum()) for a, b in zip([-1, *bounds], [*bounds, 2])]


@pytest.mark.parametrize("prior", [0.2, 0.5, 0.9])
def test_prior_from_positives_and_unlabelled(prior):
    rng = np.random.default_rng(5)
    positive = rng.normal(1.5, 1, 20_000)
    n = round(50_000 * prior)
    mixed = np.concatenate([rng.normal(1.5, 1, n), rng.normal(-1.5, 1, 50_000 - n)])
    bounds = np.quantile(positive, np.arange(1, 400) / 400)
    found = quality.best_bin(*(np.bincount(np.searchsorted(bounds, v), minlength=400) for v in (positive, mixed)))
    assert abs(found - prior) < 0.03


def test_quality_of_one_id_on_many_rows(spark, documents):
    rows = [(k, "Good words, in one line." if k % 3 else "@@## 99 ||") for k in range(90)]
    hot = [(1, f"Good words {k}.") for k in range(300)]
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(30)] + [(None, 1)], "doc_id long, quality int")
    seen = []
    taken = quality._taken

    def watched(df):
        found = taken(df)
        seen.append(len(found[0]))
        return found

    quality._taken = watched
    try:
        docs = documents(rows + hot + [(None, "x"), (None, None)])
        model = quality.train(docs, labels, lambda id: F.lit(True))
    finally:
        quality._taken = taken
    assert seen == [30, 390]  # a text for each labelled id; every row with an id
    assert all(0 <= r.score <= 1 for r in quality.score_quality(docs, model, keep=["doc_id"]).collect())


@pytest.fixture
def toxic_corpus(spark, documents):
    random.seed(8)
    say = lambda: " ".join("".join(random.choice(["ba", "to", "ri", "me", "sun", "lo"]) for _ in range(random.randrange(1, 4))) for _ in range(60))
    rows, labels = [], []
    for k in range(240):
        words = say().split()
        bad = k % 4 == 0
        for _ in range(4 if bad else 0):
            words.insert(random.randrange(60), random.choice(["vilewretch", "grubsnout"]))
        rows.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    rows += [(900, None), (901, ""), (902, "vilewretch"), (903, ("ba to ri " * 20_000) + "vilewretch grubsnout"), (903, "ba to")]
    return documents(rows), spark.createDataFrame(labels + [(None, 1), (900, None)], "doc_id long, toxic int"), dict(labels)


def test_toxicity(spark, toxic_corpus):
    docs, labels, truth = toxic_corpus
    model = toxicity.train(docs, labels, F.col("doc_id") < 180)
    got = toxicity.score_toxicity(docs, model, keep=["doc_id", "label"]).collect()
    assert len(got) == 245 and all(0 <= r.score <= 1 for r in got)
    held = [(r.score >= 0.5) == bool(truth[r.doc_id]) for r in got if 180 <= r.doc_id < 240]
    assert np.mean(held) > 0.9
    assert all(r.score < 0.5 for r in got if r.doc_id in (900, 901))
    nothing = toxicity.train(docs, labels, F.lit(False))
    assert {r.score for r in toxicity.score_toxicity(docs, nothing, keep=["doc_id"]).collect()} == {0.0}
    assert toxicity.score_toxicity(docs.where("false"), model).count() == 0


def test_toxicity_keeps_the_share_of_a_large_label_table(spark, documents, monkeypatch):
    # All toxic texts and one in seven ordinary ones hold the word: less than half of those that do are toxic.
    rows, labels = [], []
    for k in range(3000):
        bad = k % 10 == 0
        rows.append((k, f"ba to rime sun lori {'vilewretch' if bad or k % 8 == 1 else 'ba'} to rime sun lori"))
        labels.append((k, int(bad)))
    docs, labels = documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    decided = {}
    for most in (6000, 150):
        monkeypatch.setattr(toxicity, "SAMPLE", most)
        got = toxicity.score_toxicity(docs, toxicity.train(docs, labels, F.lit(True)), keep=["doc_id"]).collect()
        decided[most] = {r.doc_id for r in got if r.score >= toxicity.THRESHOLD}
        assert abs(np.mean([r.score for r in got]) - 0.1) < 0.04
    assert decided[150] == decided[6000]


def test_quality_on_held_out_rows(spark, documents):
    docs, labels = (spark.read.parquet(f"{BASE}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels, lambda id: F.pmod(F.crc32(id.cast("string")), F.lit(4)) != 2)
    scored = quality.score_quality(docs, model, keep=["doc_id"]).join(labels, "doc_id").where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2).toPandas()
    assert ((scored.score >= 0.7) == (scored.quality == 1)).mean() > 0.93
    odd = quality.score_quality(documents([(1, None), (2, ""), (3, "é"), (4, "a " * 60_000), (4, "a")]), model, keep=["doc_id", "label"]).collect()
    assert len(odd) == 5 and all(0 <= r.score <= 1 for r in odd)
    assert quality.score_quality(docs.where("false"), model).count() == 0
    untrained = quality.train(docs, labels.where("false"), lambda id: F.lit(True))
    assert {r.score for r in quality.score_quality(documents([(1, "a")]), untrained).collect()} == {0.5}
