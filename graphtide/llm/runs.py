"""Periodic runs of words, by online dyadic square catching.

A text is taken in word by word.  Whenever a block of 2^j words is complete, a catcher is
set on it.  It waits for the words that come one period later, for the periods q of its
octave (2^k <= q < 2^(k+1)), and catches where the appended words repeat its block: a suffix
comparison over 2^j words at once, by names that are made by doubling.  As a stretch of
repeated words that belongs to a run is several blocks long, neighbouring catchers catch at
the same period; their squares overlap and merge into one run, whose two ends are then found
word by word.  An appended word meets catchers of each octave a bounded number of times, so
a text of n words needs O(n log n) comparisons.

A catcher sees nothing of the text beyond two periods after its block, so the order in which
catchers of different blocks step does not matter; here all catchers of an octave step
together over all texts of an Arrow batch.

A run is a stretch of words with smallest period q that no neighbouring word extends, of at
least ``least_words`` words and ``least_periods`` periods.  Words are compared by 64-bit
hashes.

A null text has no words.  Equal rows get equal results.  Columns of the results' names are
replaced.  A task works on about a megabyte of text, or on one longer text.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from graphtide.llm.common import AS_IS, NOT_BLANK, RADIX, Words, annotate, mixed

LEAST_WORDS, LEAST_PERIODS = 24, 3
CELLS = 1 << 20  # comparisons of catchers that are made at once
STRIDE = 16  # words by which the ends of runs are extended at once


def _least_stretch(low: int, least_words: int, least_periods: int) -> int:
    """Words that repeat one period later, in any run with a period in [low, 2 * low)."""
    turn = least_words // least_periods
    periods = {low, 2 * low - 1, *(min(max(t, low), 2 * low - 1) for t in (turn, turn + 1))}
    return min(max(least_words, least_periods * q) - q for q in periods)


def _extended(seq: np.ndarray, at: np.ndarray, period: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on, in direction ``step``, repeat one period later; at most ``room``."""
    length = np.zeros(len(at), np.int64)
    live = np.flatnonzero(room > 0)
    while len(live):
        offset = length[live, None] + np.arange(STRIDE)
        within = offset < room[live, None]
        place = np.where(within, at[live, None] + step * offset, 0)
        same = (seq[place] == seq[np.where(within, place + period[live, None], 0)]) & within
        gained = np.where(same.all(1), STRIDE, same.argmin(1))
        length[live] += gained
        live = live[gained == STRIDE]
    return length


def find_runs(seq: np.ndarray, first: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """Runs as rows (start, end, period), sorted; ``seq`` has the words of all texts, ``first`` where each text begins."""
    if least_periods < 2:
        raise ValueError("a run has at least two periods")
    count = np.diff(first)
    found = np.zeros((0, 3), np.int64)
    names, size, low = seq, 1, 1
    while (texts := np.flatnonzero(count >= max(least_words, least_periods * low))).size:
        stretch = _least_stretch(low, least_words, least_periods)
        block = 1 << max(0, ((stretch + 1) // 4).bit_length() - 1)
        neighbours = stretch if block == 1 else (stretch + 1) // block - 1  # blocks that lie within any stretch so long
        if block < size:
            names, size = seq, 1
        while size < block:
            names = mixed(names[:-size] * np.uint64(RADIX) + names[size:])
            size *= 2
        caught = _caught(names, first[texts], first[texts + 1], block, low)
        found = np.concatenate([found, _merged(seq, caught, block, neighbours, found, least_words, least_periods)])
        low *= 2
    # A stretch has its smallest period; its multiples describe the same words.
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:, :2] != found[:-1, :2]).any(1)
    found = found[fresh]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _caught(names: np.ndarray, begin: np.ndarray, end: np.ndarray, block: int, low: int) -> np.ndarray:
    """(period, block's place, text's begin, text's end) of each catch, in this order."""
    catchers = (end - begin) // block
    text = np.repeat(np.arange(len(begin)), catchers)
    place = begin[text] + block * (np.arange(catchers.sum()) - np.repeat(np.cumsum(catchers) - catchers, catchers))
    parts = []
    width = min(low, CELLS)
    rows = max(1, CELLS // width)
    for shift in range(low, 2 * low, width):
        periods = np.arange(shift, min(shift + width, 2 * low))
        for a in range(0, len(place), rows):
            own = place[a : a + rows]
            last = end[text[a : a + rows]] - block  # a block may begin here at the latest
            later = own[:, None] + periods
            hit = (names[np.minimum(later, len(names) - 1)] == names[own, None]) & (later <= last[:, None])
            i, j = np.nonzero(hit)
            parts.append(np.stack([periods[j], own[i], begin[text[a + i]], end[text[a + i]]], 1))
    caught = np.concatenate(parts) if parts else np.zeros((0, 4), np.int64)
    return caught[np.lexsort((caught[:, 1], caught[:, 0]))]


def _merged(seq: np.ndarray, caught: np.ndarray, block: int, neighbours: int, known: np.ndarray, least_words: int, least_periods: int) -> np.ndarray:
    """Runs of the neighbouring blocks that were caught at the same period."""
    if not len(caught):
        return np.zeros((0, 3), np.int64)
    period, place, begin, end = caught.T
    new = np.ones(len(caught), bool)
    new[1:] = (period[1:] != period[:-1]) | (place[1:] != place[:-1] + block) | (begin[1:] != begin[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(caught)) - 1
    long = tail - head + 1 >= neighbours
    head, tail = head[long], tail[long]
    period, left, right, begin, end = period[head], place[head], place[tail] + block, begin[head], end[head]
    # Within a run of a short period its multiples catch too, and say nothing new.
    short = known[2 * known[:, 2] <= block]
    if len(short):
        short = short[np.argsort(short[:, 0], kind="stable")]
        run = np.searchsorted(short[:, 0], left, "right") - 1
        around = short[np.maximum(run, 0)]
        explained = (run >= 0) & (around[:, 1] >= right + period) & (period % around[:, 2] == 0)
        period, left, right, begin, end = (x[~explained] for x in (period, left, right, begin, end))
    left = left - _extended(seq, left - 1, period, left - begin, -1)
    stop = right + period + _extended(seq, right, period, end - period - right, 1)
    whole = stop - left >= np.maximum(least_words, least_periods * period)
    return np.stack([left, stop, period], 1)[whole]


RUN = StructType([StructField("start", LongType()), StructField("length", LongType()), StructField("period", LongType())])
FIELDS = [
    StructField("n_runs", LongType()), StructField("runs", ArrayType(RUN, False)), StructField("longest", RUN), StructField("collapsed", StringType()),
]


def _joined(words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text with one blank between."""
    text = np.repeat(np.arange(len(words.count)), words.count)[kept]
    last = np.ones(len(kept), bool)
    last[:-1] = text[1:] != text[:-1]
    size = words.end[kept] - words.start[kept] + ~last
    stop = np.cumsum(size)
    source = np.arange(stop[-1] if len(stop) else 0) + np.repeat(words.start[kept] - (stop - size), size)
    data = words.bytes[np.minimum(source, len(words.bytes) - 1)] if len(words.bytes) else np.zeros(0, np.uint8)
    data[stop[~last] - 1] = 0x20
    of_text = np.bincount(text, size, len(words.count)).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(of_text)])
    made = pa.LargeStringArray.from_buffers(len(of_text), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes()))
    return made.cast(pa.string())


def _work(least_words: int, least_periods: int) -> Callable[[], Callable[[pa.Array], list]]:
    def columns(texts: pa.Array) -> list:
        words = Words(texts, NOT_BLANK, AS_IS)
        total = int(words.first[-1])
        found = find_runs(words.hashes(), words.first, least_words, least_periods)
        text = np.searchsorted(words.first, found[:, 0], "right") - 1
        edge = np.zeros(total + 1, np.int64)
        np.add.at(edge, found[:, 0] + found[:, 2], 1)
        np.add.at(edge, found[:, 1], -1)
        kept = np.flatnonzero(np.cumsum(edge)[:total] == 0)
        runs: list[list[dict]] = [[] for _ in range(len(texts))]
        for i, (a, b, q) in zip(text.tolist(), found.tolist()):
            runs[i].append({"start": a - int(words.first[i]), "length": b - a, "period": q})
        # The first of equal ones: the smallest start, then the smallest period.
        longest = [max(r, key=lambda x: Fraction(x["length"], x["period"])) if r else None for r in runs]
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        return [pa.array([len(r) for r in runs], pa.int64()), pa.array(runs, pa.list_(kind)), pa.array(longest, kind), _joined(words, kept)]

    return lambda: columns


def collapse_runs(
    docs: DataFrame, *, text: str = "text", least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS, keep: list[str] | None = None,
) -> DataFrame:
    """Documents with ``n_runs``, ``runs`` (start, length and period in words), ``longest`` and ``collapsed``.

    ``longest`` is the run with the most periods.  ``collapsed`` has the words that no
    run holds after its first period, with one blank between.
    """
    return annotate(docs, text, FIELDS, _work(least_words, least_periods), keep)
