"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

A window is ten consecutive words of a benchmark item (a shorter item is one window).
The windows of one length make a matcher: a table gives for each block of two words how
far the search may jump before such a block can end a window; where the jump is nought,
the bucket of the window's first and last blocks names the candidates, and the words and
then the bytes are compared.  Documents are cut into stretches that the tables walk
through side by side.

Nulls and texts without words have no windows and no hits.  Repeated items and rows are
searched alike; a benchmark row without an id stands for the id ''.  An empty benchmark
leaves every document clean.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField

from graphtide.llm.common import Words, annotate, mixed, named, stored

WINDOW = 10
# Windows searched for in one pass (about 150 bytes each in a worker); more make more passes.
PASS_WINDOWS = 1_000_000
STRETCH = 256  # window starts of a stretch


def _blocks(words: np.ndarray, width: int) -> np.ndarray:
    """Code of the block that begins at each word; the last ones of width 2 wrap and are never asked for."""
    return words if width == 1 else mixed(words + np.uint64(3) * np.roll(words, -1))


class Matcher:
    """The windows of one length."""

    def __init__(self, words: np.ndarray, texts: list[bytes]) -> None:
        count, self.length = words.shape
        self.width = min(2, self.length)
        self.last = self.length - self.width
        self.mask = np.uint64((1 << min(22, max(12, (4 * count * self.length).bit_length()))) - 1)
        self.jump = np.full(int(self.mask) + 1, self.last + 1, np.int16)
        codes = np.stack([words[:, j] if self.width == 1 else mixed(words[:, j] + np.uint64(3) * words[:, j + 1]) for j in range(self.last + 1)], 1)
        for j in range(self.last + 1):
            np.minimum.at(self.jump, codes[:, j] & self.mask, self.last - j)
        buckets = self._bucket(codes[:, 0], codes[:, self.last])
        order = np.argsort(buckets, kind="stable")
        self.buckets, self.words, self.texts, self.order = buckets[order], words[order], texts, order

    @staticmethod
    def _bucket(first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mixed(first * np.uint64(5) + last)

    def find(self, doc: Words, words: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words of the occurrences, and which windows they are."""
        starts = doc.first[:-1]
        stops = np.maximum(starts, doc.first[1:] - self.length + 1)
        parts = -(-(stops - starts) // STRETCH)
        lane = np.repeat(starts, parts) + STRETCH * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        stop = np.minimum(lane + STRETCH, np.repeat(stops, parts))
        jumps = self.jump[blocks & self.mask] if len(blocks) < 4096 else None
        hits = []
        while len(lane):
            at = lane + self.last
            jump = jumps[at] if jumps is not None else self.jump[blocks[at] & self.mask]
            hits.append(lane[jump == 0])
            lane = lane + np.maximum(jump, 1)
            more = lane < stop
            lane, stop = lane[more], stop[more]
        at = np.concatenate(hits) if hits else np.zeros(0, np.int64)
        key = self._bucket(blocks[at], blocks[at + self.last])
        low, high = np.searchsorted(self.buckets, key, "left"), np.searchsorted(self.buckets, key, "right")
        size = high - low
        at, which = np.repeat(at, size), np.repeat(low, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        same = np.ones(len(at), bool)
        for j in range(self.length):
            same &= words[at + j] == self.words[which, j]
        at, which = at[same], self.order[which[same]]
        real = [doc.text(a, a + self.length) == self.texts[w] for a, w in zip(at.tolist(), which.tolist())]
        real = np.array(real, bool)
        return at[real], which[real]


def windows(items: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, bytes]]:
    """(item id, word hashes, text) of each window of a batch of (id, text)."""
    doc = Words(items.column(1))
    hashes = doc.hashes()
    for k, item in enumerate(items.column(0).to_pylist()):
        a, n = int(doc.first[k]), int(doc.count[k])
        length = min(n, WINDOW)
        for i in range(a, a + n - length + 1) if n else ():
            yield item or "", hashes[i : i + length], doc.text(i, i + length)


def build(found: list[tuple[str, np.ndarray, bytes]]) -> list[tuple[Matcher, list[list[str]]]]:
    """Matchers by length, each with the item ids of its windows."""
    by_length: dict[int, dict[bytes, tuple[np.ndarray, set[str]]]] = {}
    for item, hashes, text in found:
        by_length.setdefault(len(hashes), {}).setdefault(text, (hashes, set()))[1].add(item)
    return [
        (Matcher(np.stack([h for h, _ in group.values()]), list(group)), [sorted(i) for _, i in group.values()])
        for _, group in sorted(by_length.items())
    ]


FIELDS = [
    StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("n_items", LongType()),
    StructField("items_sha256", StringType()), StructField("contaminated", BooleanType()),
    StructField("hit_words", ArrayType(IntegerType(), False)), StructField("hit_items", ArrayType(StringType(), False)),
]


def _search(matchers) -> "callable":
    tables = matchers.value

    def columns(texts: pa.Array) -> list[pa.Array]:
        doc = Words(texts)
        words = doc.hashes()
        blocks = {w: _blocks(words, w) for w in {m.width for m, _ in tables}}
        delta = np.zeros(len(words) + 1, np.int64)
        items: dict[int, set[str]] = {}
        for matcher, ids in tables:
            at, which = matcher.find(doc, words, blocks[matcher.width])
            np.add.at(delta, at, 1)
            np.add.at(delta, at + matcher.length, -1)
            for row, w in zip((np.searchsorted(doc.first, at, "right") - 1).tolist(), which.tolist()):
                items.setdefault(row, set()).update(ids[w])
        covered = np.cumsum(delta[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(covered)])
        hit = total[doc.first[1:]] - total[doc.first[:-1]]
        spans, names = [], []
        for row in range(len(texts)):
            names.append(sorted(items.get(row, ())))
            inside = covered[doc.first[row] : doc.first[row + 1]] if hit[row] else np.zeros(0, bool)
            spans.append(np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0)).tolist() if hit[row] else [])
        return [
            pa.array(doc.count, pa.int64()), pa.array(hit, pa.int64()), pa.array([len(x) for x in names], pa.int64()),
            pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]), pa.array(hit > 0),
            pa.array(spans, pa.list_(pa.int32())), pa.array(names, pa.list_(pa.string())),
        ]

    return columns


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    keep: list[str] | None = None, pass_windows: int = PASS_WINDOWS,
) -> DataFrame:
    """Documents with their hits: word count, covered words, items, and the covered word ranges.

    ``hit_words`` holds begin and end of each covered range, ``hit_items`` the item ids.
    The benchmark is read on the driver in parts of at most ``pass_windows`` windows;
    each part is broadcast and searched for in one pass, whose result is stored before
    the next, so that neither driver nor workers hold more than one part.
    """
    spark = docs.sparkSession
    rows = benchmark.select(named(item_id).cast("string").alias("item"), named(item_text).cast("string").alias("text")).where("text is not null")
    parts = _parts(rows, pass_windows)
    first = next(parts, [])
    second = next(parts, None)
    result = annotate(docs, text, FIELDS, partial(_search, spark.sparkContext.broadcast(build(first))), keep)
    if second is None:
        return result
    # Several passes: keep rows apart by position, as ids may repeat, and merge the ranges.
    columns = result.columns
    here = stored(docs.select("*", F.monotonically_increasing_id().alias("␟row")), "decontaminate-rows")
    part, hits = first, None
    for number in range(1 << 30):
        found = annotate(here, text, FIELDS, partial(_search, spark.sparkContext.broadcast(build(part))), ["␟row"])
        found = stored(found.where("contaminated").select("␟row", "hit_words", "hit_items"), f"decontaminate-{number}")
        hits = found if hits is None else hits.unionByName(found)
        part = second if number == 0 else next(parts, None)
        if part is None:
            break
    none = annotate(here, text, FIELDS, partial(_search, spark.sparkContext.broadcast([])), [*(keep or docs.columns), "␟row"])
    begins = F.filter("hit_words", lambda _, i: i % 2 == 0)
    ends = F.transform(begins, lambda x, i: F.struct(x.alias("a"), F.get("hit_words", i * 2 + 1).alias("b")))
    one = hits.select("␟row", "hit_items", ends.alias("r")).groupBy("␟row").agg(
        F.array_sort(F.flatten(F.collect_list("r"))).alias("r"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_items")))).alias("items"))
    flat = F.aggregate(
        "r", F.array().cast("array<int>"),
        lambda out, x: F.when((F.size(out) > 0) & (F.element_at(out, -1) >= x["a"]), F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.greatest(F.element_at(out, -1), x["b"])))).otherwise(F.concat(out, F.array(x["a"], x["b"]))))
    one = one.select("␟row", "items", flat.alias("spans"))
    one = one.withColumn("hit", F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("bigint"), lambda a, x: a + x))
    joined = none.join(one.withColumnsRenamed({"items": "␟items", "spans": "␟spans", "hit": "␟hit"}), "␟row", "left")
    names = F.coalesce("␟items", F.array().cast("array<string>"))
    return joined.withColumns({
        "n_hit": F.coalesce("␟hit", F.lit(0)), "n_items": F.size(names).cast("bigint"), "items_sha256": F.sha2(F.array_join(names, ","), 256),
        "contaminated": F.col("␟hit").isNotNull(), "hit_words": F.coalesce("␟spans", F.array().cast("array<int>")), "hit_items": names,
    }).select(*[named(c) for c in columns])


def _parts(rows: DataFrame, limit: int) -> Iterator[list[tuple[str, np.ndarray, bytes]]]:
    """The windows of the benchmark in lists of about ``limit``, one partition at a time on the driver."""
    part: list[tuple[str, np.ndarray, bytes]] = []
    for row in rows.toLocalIterator():
        part += windows(pa.RecordBatch.from_arrays([pa.array([row[0]], pa.string()), pa.array([row[1]], pa.string())], names=["item", "text"]))
        if len(part) >= limit:
            yield part
            part = []
    if part:
        yield part
