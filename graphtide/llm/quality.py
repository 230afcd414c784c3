"""Quality by positive-unlabelled learning.

A linear model over the shape of a whole text (histogram of character-class trigrams,
repetition of words and lines, lengths) minimises the non-negative unbiased risk

    prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)])

with trusted positives P and unlabelled texts U: every text whose id is trusted, its label
unseen, as E_U is the mean over texts of both classes (so no text is moved to look for its
label).  E_U, its gradient and the spread of the features are taken over all of U: their
features are stored once and each round sums them in parallel.  A Newton step needs the curvature too, and that comes from
a sample; it changes the way to the minimum, not the minimum.

The class prior is estimated from P and U alone (``best_bin``).  Negative labels serve the
calibration of the score only (logistic, on one number, at the trusted labels' share of
positives).  At most ``SAMPLE`` texts each of the positives and the labelled negatives are
learned from, in the order of a hash of the id; an id that repeats gives one text, the
least.

A null text is an empty one and is scored as such.  Rows without an id teach nothing.
Without trusted positives or unlabelled texts the score is the share of positives among
the trusted labels (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField

from graphtide.llm.common import annotate, code_points, named, stored
from graphtide.llm.learning import Logistic, labelled

SAMPLE = 6000
CLASSES = 8
WIDTH = CLASSES**3 + 8
THRESHOLD = 0.7
ROUNDS, RIDGE, SETTLED = 10, 0.2, 1e-3
BINS = 4096
BLANK, BREAK, LOWER, UPPER, DIGIT, LETTER, STOP, SIGN = range(CLASSES)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point of the basic plane; those above are letters."""
    out = np.full(0x10000, SIGN, np.uint8)
    for point in range(len(out)):
        c = chr(point)
        if c.isalpha():
            out[point] = LETTER if point > 127 else UPPER if c.isupper() else LOWER
        elif c.isdigit():
            out[point] = DIGIT
        elif c.isspace():
            out[point] = BREAK if c == "\n" else BLANK
        elif c in ".,;:'\"()-":
            out[point] = STOP
    return out


def _shape(text: str) -> list[float]:
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, m = max(1, len(words)), max(1, len(lines))
    return [
        np.log1p(len(text)), np.log1p(len(words)), np.log1p(len(text) / m), len(text) / n,
        len(set(words)) / n**0.9, sum(map(str.__eq__, words, words[1:])) / n, 1 - len(set(lines)) / m if lines else 0.0,
        float(not words),
    ]


def features(texts: pa.Array) -> np.ndarray:
    """A row for each text: square roots of the trigram shares, then the shape."""
    points, first = code_points(texts)
    kind = np.where(points < 0x10000, _classes()[np.minimum(points, 0xFFFF)], LETTER).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    gram = np.zeros(0, np.int64)
    if len(kind) > 2:
        gram = (kind[:-2] * CLASSES + kind[1:-1]) * CLASSES + kind[2:]
        inside = text[:-2] == text[2:]
        gram = text[:-2][inside] * CLASSES**3 + gram[inside]
    counts = np.bincount(gram, minlength=len(texts) * CLASSES**3).reshape(len(texts), CLASSES**3)
    shares = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
    return np.concatenate([shares, np.array([_shape(t or "") for t in texts.to_pylist()]).reshape(len(texts), -1)], 1)


@dataclass
class QualityModel:
    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    calibration: Logistic | None = None

    def margin(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        margin = self.margin(x)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30))) if self.calibration is None else self.calibration(margin[:, None])


def _rate(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def best_bin(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1, gamma: float = 0.01) -> float:
    """Estimate of the class prior from the numbers of P and U in the bins of a score, the best bins last.

    Above any bar, the share of U is at least the prior times the share of P, and near it
    where hardly a negative scores so high.  The bar with the least upper bound of that ratio
    is taken (best bin estimation; the bound fails with probability ``delta``).
    """
    n_p, n_u = positive.sum(), unlabelled.sum()
    q_p, q_u = positive[::-1].cumsum() / n_p, unlabelled[::-1].cumsum() / n_u
    slack = np.sqrt(np.log(4 / delta) / 2 / n_p) + np.sqrt(np.log(4 / delta) / 2 / n_u)
    at = q_p > 0
    best = np.argmin((q_u[at] + (1 + gamma) * slack) / q_p[at])
    return float(np.clip(q_u[at][best] / q_p[at][best], 0.01, 0.99))


def minimise_risk(positive: np.ndarray, sample: np.ndarray, prior: float, mean: np.ndarray, scale: np.ndarray,
                  over_all: Callable[[np.ndarray], tuple[float, np.ndarray]]) -> QualityModel:
    """Newton steps on the non-negative risk with the logistic loss.

    ``over_all`` gives the mean of l(-f) over all unlabelled texts and its gradient;
    ``sample`` are some of these texts, for the curvature.
    """
    p, u = (np.c_[(x - mean) / scale, np.ones(len(x))] for x in (positive, sample))
    w = np.zeros(p.shape[1])
    last, step, best = np.inf, w, w
    for _ in range(ROUNDS):
        at_p = p @ w
        loss_u, slope_u = over_all(w)
        negative = loss_u - prior * np.logaddexp(0, at_p).mean()
        risk = prior * np.logaddexp(0, -at_p).mean() + negative + RIDGE / 2 * w @ w
        if negative < 0 or risk > last + 1e-9:
            # Below nought the unlabelled part is overfitted: go back.  A risk that grows
            # is a step too long, as the curvature is a sample's.
            step = step / 2
            w = w - step
            continue
        last, best = risk, w
        slope = slope_u - prior * p.mean(0) + RIDGE * w  # l(f) - l(-f) is -f for this loss
        if np.abs(slope).max() < SETTLED:
            break
        at_u = _rate(u @ w)
        curve = (u * (at_u * (1 - at_u))[:, None]).T @ u / len(u) + RIDGE * np.eye(len(w))
        step = -np.linalg.solve(curve, slope)
        w = w + step
    return QualityModel(prior, mean, scale, best)


def _packed() -> Callable[[pa.Array], list]:
    return lambda texts: [pa.array([x.tobytes() for x in features(texts).astype(np.float16)], pa.binary())]


def _unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).astype(np.float64).reshape(len(column), WIDTH)


class Unlabelled:
    """Stored features (column ``f``) of all unlabelled texts, and sums over them.

    A task adds up its rows and sends one vector, and vectors meet by position before they
    come to the driver: it gets one vector, whatever the number of texts or tasks.
    """

    def __init__(self, df: DataFrame) -> None:
        self.df = df
        self.n, total, squares = np.split(self._sum(lambda x: np.concatenate([[len(x)], x.sum(0), (x**2).sum(0)]), 2 * WIDTH + 1), [1, WIDTH + 1])
        self.n = int(self.n[0])
        self.mean = total / max(1, self.n)
        self.scale = np.sqrt(np.maximum(squares / max(1, self.n) - self.mean**2, 0)) + 0.01

    def _sum(self, vector: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                if batch.num_rows:
                    total += vector(_unpacked(batch.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], names=["v"])

        placed = self.df.select("f").mapInArrow(run, "v array<double>").select(F.posexplode("v").alias("at", "v"))
        out = np.zeros(size)
        for at, value in placed.groupBy("at").agg(F.sum("v").alias("v")).collect():
            out[at] = value
        return out

    def risk(self, weights: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean of log(1 + exp(f)) over all texts and its gradient."""
        mean, scale = self.mean, self.scale

        def vector(x: np.ndarray) -> np.ndarray:
            x = np.c_[(x - mean) / scale, np.ones(len(x))]
            at = x @ weights
            return np.concatenate([[np.logaddexp(0, at).sum()], x.T @ _rate(at)])

        sums = self._sum(vector, WIDTH + 2) / self.n
        return float(sums[0]), sums[1:]

    def histogram(self, score: Logistic, bounds: np.ndarray) -> np.ndarray:
        """Texts in each bin of a score; the bins are cut at ``bounds``."""
        return self._sum(lambda x: np.bincount(np.searchsorted(bounds, score(x), "right"), minlength=len(bounds) + 1), len(bounds) + 1)


def estimate_prior(positive: np.ndarray, sample: np.ndarray, unlabelled: Unlabelled) -> float:
    """Class prior from P and U: half of P teaches P from U, the other half and all of U are binned by that score."""
    teach, judge = positive[::2], positive[1::2] if len(positive) > 1 else positive
    score = Logistic.fit(np.concatenate([teach, sample]), np.repeat([1, 0], [len(teach), len(sample)]))
    judged = score(judge)
    bounds = np.unique(np.quantile(judged, np.arange(1, BINS) / BINS))
    n_p = np.bincount(np.searchsorted(bounds, judged, "right"), minlength=len(bounds) + 1)
    return best_bin(n_p, unlabelled.histogram(score, bounds))


def train(docs: DataFrame, labels: DataFrame, trusted: Callable[[Column], Column], *, label: str = "quality", id: str = "doc_id", text: str = "text") -> QualityModel:
    """Learn from the labels that ``trusted`` lets through; it makes a condition of the id column."""
    share = labels.where(trusted(named(id)) & named(label).isin(0, 1)).agg(F.avg(named(label).cast("double"))).head()[0]
    share = float(np.clip(0.5 if share is None else share, 0.01, 0.99))
    made = [StructField("f", BinaryType())]
    one_each = labelled(docs, labels, label, trusted(named(id)), SAMPLE, id=id, text=text).groupBy("id", "label").agg(F.min("text").alias("text"))
    y, x = _taken(stored(annotate(one_each, "text", made, _packed, ["label"]), "quality-labelled").select("label", "f"))
    if not (y == 1).any():
        return QualityModel(share)
    texts = docs.select(named(id).alias("␟id"), named(text).cast("string").alias("text")).where(trusted(F.col("␟id")) & F.col("␟id").isNotNull())
    free = stored(annotate(texts, "text", made, _packed, ["␟id"]), "quality-unlabelled")
    unlabelled = Unlabelled(free)
    if not unlabelled.n:
        return QualityModel(share)
    # Rows, not ids, are counted here, so repeats of an id are bounded as well.
    order = F.xxhash64(F.col("␟id").cast("string"))
    _, sample = _taken(free.orderBy(order, "␟id", "f").limit(SAMPLE).select(F.lit(-1).alias("label"), "f"))
    prior = estimate_prior(x[y == 1], sample, unlabelled)
    model = minimise_risk(x[y == 1], sample, prior, unlabelled.mean, unlabelled.scale, unlabelled.risk)
    if (y == 0).any():
        # The classes are sampled alike, so each is weighted to its share by repetition of its margin's quantiles.
        wanted = {1: round(20_000 * share), 0: 20_000 - round(20_000 * share)}
        margins = {v: np.quantile(model.margin(x[y == v]), (np.arange(n) + 0.5) / n) for v, n in wanted.items()}
        model.calibration = Logistic.fit(np.concatenate([margins[1], margins[0]])[:, None], np.repeat([1, 0], [wanted[1], wanted[0]]))
    return model


def _taken(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Labels and features of a bounded sample, on the driver."""
    found = rows.toArrow()
    return found.column(0).to_numpy(), _unpacked(found.column(1).combine_chunks())


def _score(shared) -> Callable[[pa.Array], list]:
    model: QualityModel = shared.value
    return lambda texts: [pa.array(model.score(features(texts)))]


def score_quality(docs: DataFrame, model: QualityModel, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Documents with ``score``, 0 to 1."""
    return annotate(docs, text, [StructField("score", DoubleType())], partial(_score, docs.sparkSession.sparkContext.broadcast(model)), keep)
