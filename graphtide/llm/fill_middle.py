"""Fill-in-the-middle training texts, cut between words by a wavelet matrix.

The characters of a batch of texts are one sequence of classes: blank, letter, digit or
sign, and whether the character ends a word.  A wavelet matrix over it answers how often a
class occurs before a place (rank).  The ranks of the three classes that end a word add up
to the words that are complete there, and bisection on that sum finds the place where a
given number of units is complete.  A unit is a word with the blanks before it; blanks at
the end of a text are a unit of their own.

A hash of the id picks the form (``plain``, ``psm``, ``spm``) and the two cuts, so a text
is cut alike in every run, whichever task has it.  A text that holds one of the marks stays
plain: the marks of an output are then the only ones, and ``restored`` undoes it exactly.

A null text is an empty one and plain; a null id hashes like an empty one.  Equal rows get
equal results.  Columns of the results' names are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from graphtide.llm.common import annotate, code_points, named

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLANK, LETTER, DIGIT, SIGN, LAST = 0, 1, 2, 3, 4  # the last character of a word has LAST added
_U = np.uint64


class WaveletMatrix:
    """Symbols below ``2 ** bits``; for each bit a bit row with counts, sorted by the bits above."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.bits, self.rows = bits, []
        for bit in reversed(range(bits)):
            ones = (symbols >> bit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(symbols) // 64 + 1, _U)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.rows.append((words, before, len(symbols) - int(before[-1])))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: int, ends: np.ndarray) -> np.ndarray:
        """How often the symbol occurs before each of the places."""
        places = np.append(ends, 0).astype(np.int64)
        for bit, (words, before, zeros) in zip(reversed(range(self.bits)), self.rows):
            below = (_U(1) << (places & 63).astype(_U)) - _U(1)
            ones = before[places >> 6] + np.bitwise_count(words[places >> 6] & below)
            places = zeros + ones if symbol >> bit & 1 else places - ones
        return places[:-1] - places[-1]


class Units:
    """Where the units of a batch of texts end."""

    def __init__(self, texts: pa.Array) -> None:
        points, self.offsets = code_points(texts)
        blank = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
        letter = ((points | 32) >= 97) & ((points | 32) <= 122) | (points >= 0x80)
        classes = np.where(blank, BLANK, np.where(letter, LETTER, np.where((points >= 48) & (points <= 57), DIGIT, SIGN))).astype(np.uint8)
        ends = np.ones(len(points), bool)
        ends[:-1] = blank[1:]
        stops = self.offsets[1:][np.diff(self.offsets) > 0] - 1
        ends[stops] = True
        self.matrix = WaveletMatrix(np.where(ends & ~blank, classes + LAST, classes), 3)
        self.before = self._complete(self.offsets)
        self.words = np.diff(self.before)
        trailing = np.zeros(len(texts), bool)
        trailing[np.diff(self.offsets) > 0] = blank[stops]
        self.count = self.words + trailing

    def _complete(self, places: np.ndarray) -> np.ndarray:
        return sum(self.matrix.rank(kind + LAST, places) for kind in (LETTER, DIGIT, SIGN))

    def cut(self, units: np.ndarray) -> np.ndarray:
        """Code points of each text up to the end of its first ``units`` units, by bisection on the ranks."""
        low, high = self.offsets[:-1].copy(), self.offsets[1:].copy()
        wanted = self.before[:-1] + np.minimum(units, self.words)
        while (low < high).any():
            middle = (low + high) // 2
            enough = self._complete(middle) >= wanted
            high, low = np.where(enough, middle, high), np.where(enough, low, np.minimum(middle + 1, high))
        return np.where(units > self.words, np.diff(self.offsets), low - self.offsets[:-1])


FIELDS = [
    StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()),
    StructField("output", StringType()),
]


def _work(fim_percent: int, spm_percent: int) -> Callable[[], Callable[..., list]]:
    def columns(texts: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> list:
        units = Units(texts)
        draws = [h.to_numpy() % (units.count + 1) for h in (h1, h2)]
        first, second = units.cut(np.minimum(*draws)), units.cut(np.maximum(*draws))
        forms, prefixes, middles, outputs = [], [], [], []
        whole, spm = h3.to_numpy() % 100 >= fim_percent, h4.to_numpy() % 100 < spm_percent
        for text, a, b, plain, turned in zip(texts.to_pylist(), first.tolist(), second.tolist(), whole.tolist(), spm.tolist()):
            text = text or ""
            if plain or not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
                made = ("plain", None, None, text)
            elif turned:
                made = ("spm", a, b - a, "".join((SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b])))
            else:
                made = ("psm", a, b - a, "".join((PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b])))
            for column, value in zip((forms, prefixes, middles, outputs), made):
                column.append(value)
        return [pa.array(units.count, pa.int64()), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()), pa.array(outputs, pa.string())]

    return lambda: columns


def fill_in_middle(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", seed: int = 42, fim_percent: int = 50, spm_percent: int = 80, keep: list[str] | None = None,
) -> DataFrame:
    """Documents with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` (null if plain) and ``output``.

    ``fim_percent`` of the texts are cut, ``spm_percent`` of these begin with their suffix.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(named(id).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]
    return annotate(docs, text, FIELDS, _work(fim_percent, spm_percent), keep, draws)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    head, middle = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)
    psm = [F.substring_index(F.substring_index(head, SUFFIX, 1), PREFIX, -1), F.substring_index(head, SUFFIX, -1)]
    spm = [F.substring_index(head, PREFIX, -1), F.substring_index(F.substring_index(head, PREFIX, 1), SUFFIX, -1)]
    joined = lambda parts: F.concat(parts[0], middle, parts[1])
    return F.when(form == "psm", joined(psm)).when(form == "spm", joined(spm)).otherwise(output)
