"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled texts.  The ordinary one holds the
most frequent words of ordinary texts; the toxic one holds these too and, behind them,
the passages of toxic texts whose six-byte grams occur in a far larger share of toxic
than of ordinary texts.  Each window of a text is compressed with both; what the toxic
dictionary saves is the distance.  The savings of a text's windows (largest, sum, sum for
the square root of the windows) are turned into a score by a logistic regression on
labelled texts that the dictionaries have not seen, each class weighted to its share of
all trusted labels, so that a score is a probability whatever the sample's mix.

The dictionaries and the regression see at most ``SAMPLE`` labelled texts of each class.
A null text is an empty one: its score is that of a text without windows' savings.  With
fewer than ``LEAST`` texts of a class nothing can be learned and the score is 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField

from graphtide.llm.common import annotate, pieces, stored
from graphtide.llm.learning import Logistic, known, labelled

SAMPLE = 6000  # labelled texts of each class that are learned from
LEAST = 8
GRAM = 6
TIMES_AS_FREQUENT, LEAST_G2 = 6.0, 20.0
TOXIC_BYTES, ORDINARY_BYTES, ORDINARY_WORDS = 16_384, 8_192, 3_000
WINDOW, OVERLAP = 120, 8
THRESHOLD = 0.7


def plain(text: str | None) -> bytes:
    """Lower case, single blanks, a blank at both ends."""
    return f" {' '.join((text or '').lower().split())} ".encode("utf-8", "replace")


def _grams(text: bytes) -> np.ndarray:
    """The grams of a text as 48-bit numbers, in order."""
    data = np.frombuffer(text, np.uint8).astype(np.uint64)
    out = np.zeros(max(0, len(data) - GRAM + 1), np.uint64)
    for k in range(GRAM):
        out |= data[k : k + len(out)] << np.uint64(8 * k)
    return out


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, texts, toxic texts) of each piece; rows are (text, label)."""
    for piece in pieces(batches, 0):
        found = [(np.unique(_grams(plain(t))), label) for t, label in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist())]
        grams = np.concatenate([g for g, _ in found])
        toxic = np.repeat([label for _, label in found], [len(g) for g, _ in found])
        keys, place = np.unique(grams, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.astype(np.int64)), pa.array(np.bincount(place, minlength=len(keys))), pa.array(np.bincount(place, toxic, len(keys)).astype(np.int64))],
            names=["gram", "n", "n_toxic"])


def _count_stretches(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bytes, times) of the maximal stretches made of marked grams only; rows are (text)."""
    marked = shared.value
    for piece in pieces(batches, 0):
        counts: Counter[bytes] = Counter()
        for text in map(plain, piece.column(0).to_pylist()):
            inside = np.concatenate([[0], np.isin(_grams(text), marked).astype(np.int8), [0]])
            edges = np.flatnonzero(np.diff(inside))
            counts.update(text[a : b + GRAM - 1] for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()))
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["stretch", "n"])


def _parameters() -> zstandard.ZstdCompressionParameters:
    # The fast strategy with a target length leaves literals as they are, so that lengths count bytes.
    return zstandard.ZstdCompressionParameters(
        window_log=15, hash_log=15, chain_log=14, search_log=4, min_match=GRAM, target_length=1, strategy=zstandard.STRATEGY_FAST,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)


def _compressor(content: bytes) -> Callable[[bytes], bytes]:
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=_parameters())
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=_parameters()).compress


def savings(texts: pa.Array, ordinary: Callable[[bytes], bytes], toxic: Callable[[bytes], bytes]) -> np.ndarray:
    """Features of each text from what the toxic dictionary saves in its windows."""
    out = np.zeros((len(texts), 5))
    for row, text in enumerate(map(plain, texts.to_pylist())):
        windows = [text[a : a + WINDOW + OVERLAP] for a in range(0, max(1, len(text) - OVERLAP), WINDOW)]
        saved = np.array([len(ordinary(w)) - len(toxic(w)) for w in windows])
        total = np.maximum(saved, 0).sum()
        out[row] = saved.max(), np.log1p(total), total / len(windows) ** 0.5, np.log1p(total / len(windows)), np.log(len(windows))
    return out


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    score: Logistic | None


def _features(ordinary: bytes, toxic: bytes) -> Callable[[pa.Array], list]:
    plain_side, toxic_side = _compressor(ordinary), _compressor(toxic)
    return lambda texts: [pa.array(savings(texts, plain_side, toxic_side).tolist(), pa.list_(pa.float64()))]


def train(docs: DataFrame, labels: DataFrame, trusted: Column, *, label: str = "toxic", id: str = "doc_id", text: str = "text") -> ToxicityModel:
    """Learn from the labelled rows that ``trusted`` (a condition on ``labels``) lets through."""
    spark = docs.sparkSession
    sample = stored(labelled(docs, labels, label, trusted, SAMPLE, id=id, text=text).withColumn("part", F.pmod(F.crc32(F.concat(F.lit("part"), F.col("id").cast("string"))), F.lit(2))), "toxicity-sample")
    count = {(r["label"], r["part"]): r["n"] for r in sample.groupBy("label", "part").agg(F.count("*").alias("n")).collect()}
    if min(count.get((value, part), 0) for value in (0, 1) for part in (0, 1)) < LEAST:
        return ToxicityModel(b" ", b" ", None)

    half = sample.where("part = 0")
    n, n_toxic = count[0, 0] + count[1, 0], count[1, 0]
    grams = half.select("text", "label").mapInArrow(_count_grams, "gram bigint, n bigint, n_toxic bigint").groupBy("gram").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("t"))
    ordinary = F.col("n") - F.col("t")
    part = lambda seen, size: F.when(seen > 0, seen * F.log(seen * n / (size * F.col("n")))).otherwise(0.0)
    grams = grams.where((F.col("t") / n_toxic >= TIMES_AS_FREQUENT * (ordinary + 1) / (n - n_toxic)) & (F.col("t") >= 4))
    grams = grams.withColumn("g2", 2 * (part(F.col("t"), n_toxic) + part(ordinary, n - n_toxic))).where(F.col("g2") >= LEAST_G2)
    marked = np.sort(np.array([r["gram"] for r in grams.orderBy(F.desc("g2"), "gram").limit(TOXIC_BYTES).collect()], np.int64).astype(np.uint64))

    stretches = half.where("label = 1").select("text").mapInArrow(partial(_count_stretches, spark.sparkContext.broadcast(marked)), "stretch binary, n bigint")
    stretches = stretches.groupBy("stretch").agg(F.sum("n").alias("n")).orderBy(F.desc(F.col("n") * F.length("stretch")), "stretch").limit(TOXIC_BYTES)
    seen: set[int] = set()
    passages, size = [], 0
    for row in stretches.collect():
        own = set(_grams(bytes(row["stretch"])).tolist())
        if own - seen and size + len(row["stretch"]) < TOXIC_BYTES:
            passages.append(bytes(row["stretch"]))
            seen |= own
            size += len(row["stretch"]) + 1

    words = half.where("label = 0").select(F.explode(F.split(F.lower("text"), r"\s+")).alias("word")).where("word <> ''")
    frequent = words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(ORDINARY_WORDS).collect()
    taken = set(marked.tolist())
    common = [w for w in (f" {r['word']} ".encode() for r in frequent) if not taken & set(_grams(w).tolist())]
    ordinary_bytes = b"".join(common[::-1])[-ORDINARY_BYTES:] or b" "
    toxic_bytes = ordinary_bytes + b"\0" + b"\0".join(passages[::-1])

    rows = annotate(sample.where("part = 1").select("text", "label"), "text", [StructField("f", ArrayType(DoubleType()))], partial(_features, ordinary_bytes, toxic_bytes), ["label"])
    rows = rows.toArrow()
    x, y = np.array(rows.column("f").to_pylist()), rows.column("label").to_numpy()
    # The classes are sampled alike, so each is weighted to its share of all trusted labels.
    of_class = {r["label"]: r["n"] for r in known(labels, label, trusted, id=id).groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = np.array([of_class[0], of_class[1]]) / sum(of_class.values())
    return ToxicityModel(ordinary_bytes, toxic_bytes, Logistic.fit(x, y, counts=(share * len(y) / np.bincount(y, minlength=2))[y]))


FIELDS = [StructField("score", DoubleType())]


def _score(shared) -> Callable[[pa.Array], list]:
    model: ToxicityModel = shared.value
    if model.score is None:
        return lambda texts: [pa.array(np.zeros(len(texts)))]
    ordinary, toxic = _compressor(model.ordinary), _compressor(model.toxic)
    return lambda texts: [pa.array(model.score(savings(texts, ordinary, toxic)))]


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Documents with ``score``, 0 to 1."""
    return annotate(docs, text, FIELDS, partial(_score, docs.sparkSession.sparkContext.broadcast(model)), keep)
