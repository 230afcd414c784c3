"""What the operators share: tables, stored results, Arrow batches of texts, words and hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from graphtide.streaming.files import shared_dir

# Bytes of text that a task works on at once; one longer text makes a piece of its own.
PIECE_BYTES = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result to the shared folder and read it back: short lineage, computed once."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def named(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fold(id_column: Column, parts: int) -> Column:
    """Fold of a row, crc32 of the id as text; a row without an id is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string")), F.lit(parts)), F.lit(0))


def pieces(batches: Iterator[pa.RecordBatch], at: int, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts (column ``at``) of a piece have about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def annotate(
    df: DataFrame,
    text: str,
    fields: list[StructField],
    work: Callable[[], Callable[..., list]],
    keep: list[str] | None = None,
    also: Sequence[Column] = (),
) -> DataFrame:
    """Add the columns ``fields``, computed from the texts in Arrow batches.

    ``work()`` is called once in each task and gives the function from texts to
    columns.  ``keep`` names the input columns to return (all by default).  An
    input column that has the name of a new one is replaced by it.  The values of
    ``also`` are handed to that function beside the texts and not returned.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    schema = StructType([df.schema[c] for c in kept] + fields)
    at = kept.index(text) if text in kept and dict(df.dtypes)[text] == "string" else len(kept)
    own = [named(text).cast("string").alias("␟text")] if at == len(kept) else []
    source = df.select(*[named(c) for c in kept], *own, *[c.alias(f"␟also-{i}") for i, c in enumerate(also)])
    names, beside = schema.names, range(len(kept) + len(own), len(kept) + len(own) + len(also))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = work()
        for piece in pieces(batches, at):
            made = columns(piece.column(at), *(piece.column(i) for i in beside))
            yield pa.RecordBatch.from_arrays([*(piece.column(i) for i in range(len(kept))), *made], names=names)

    return source.mapInArrow(run, schema)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each begins, one more offset at the end; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the public splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


RADIX = 0x9E3779B97F4A7C15
_INVERSE = pow(RADIX, -1, 1 << 64)


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (RADIX, _INVERSE):
        p = np.full(1 << bits, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


_code = np.arange(256, dtype=np.uint8)
LOWER = np.where((_code >= 65) & (_code <= 90), _code + 32, _code).astype(np.uint8)
AS_IS = _code
IS_WORD = (_code >= 0x80) | ((_code >= 48) & (_code <= 57)) | ((_code >= 97) & (_code <= 122))
NOT_BLANK = (_code != 0x20) & ((_code < 0x09) | (_code > 0x0D))


class Words:
    """Words of a batch of texts: runs of ASCII letters (lower-cased), digits and all above ASCII.

    ``word`` marks other bytes as those of words, ``case=AS_IS`` leaves letters as they are.
    """

    def __init__(self, texts: pa.Array, word: np.ndarray = IS_WORD, case: np.ndarray = LOWER) -> None:
        data, offsets = utf8(texts)
        self.bytes = case[data]
        inside = word[self.bytes]
        n = len(data)
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        before &= ~cut[:n]
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        after &= ~cut[1:]
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)  # of each text, one more at the end
        self.count = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word, the same in every batch."""
        n = len(self.bytes)
        if not n:
            return np.zeros(0, np.uint64)
        up, down = _powers(max(16, int(n).bit_length()))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        return mixed((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))

    def text(self, a: int, b: int) -> bytes:
        """Words a to b (exclusive) with one blank between."""
        return b" ".join(self.bytes[s:e].tobytes() for s, e in zip(self.start[a:b], self.end[a:b]))


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts and where each text begins, one more offset at the end; null is empty."""
    data, offsets = utf8(texts)
    first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) == first[-1]:
        return points, first[offsets]
    # Bytes that are not UTF-8: decode text by text, so that each keeps its place.
    each = [np.frombuffer(data[a:b].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32) for a, b in zip(offsets, offsets[1:])]
    return np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])
