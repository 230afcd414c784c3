"""A snapshot read in chunks while the stream follows the changes.

Before a chunk is read, the source's place in its log is noted: its low mark.  The rows of
the chunk are ordered at that mark.  What a row holds from before the mark wins over older
changes; what changes during the read or later stands behind the mark in the log, so the
stream delivers it and it wins over the chunk, whether the chunk saw it or not.  Nothing
needs a lock, and no mark is needed after the read.  The stream must begin at or before
the first mark, and changes must carry whole rows.

Which batch holds which chunk is noted before the batch is written:

    <root>/chunks/<name>/<chunk>.<batch>

A replayed batch reads its chunks again; a chunk whose batch was never completed is dealt anew.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphtide.plans.spec import quoted
from graphtide.sources.envelopes import ENVELOPE, data_envelope, seq_of
from graphtide.sources.snapshot import snapshot_envelopes
from graphtide.streaming.files import join
from graphtide.streaming.store import GraphStore


def chunk_bounds(table: DataFrame, column: str, rows: int) -> list:
    """Cuts of a number, date or time column into chunks of about ``rows`` rows; two passes over that column.

    A value that fills several chunks by itself makes one larger chunk.
    """
    total = table.select(quoted(column)).count()
    chunks = math.ceil(total / rows)
    if chunks < 2:
        return []
    cuts = F.percentile_approx(quoted(column), [k / chunks for k in range(1, chunks)], 100 * chunks)
    return sorted({c for c in table.agg(cuts).head()[0] or []})


def in_chunk(column: str, bounds: list, number: int) -> Column:
    """Rows of a chunk: from its lower bound up to the next one; nulls are in the first."""
    value = F.col(quoted(column))
    condition = F.lit(True)
    if number > 0:
        condition = condition & (value >= F.lit(bounds[number - 1]))
    if number < len(bounds):
        condition = condition & (value < F.lit(bounds[number]))
    return condition | value.isNull() if number == 0 else condition


class ChunkedSnapshot:
    """The rows of one source table, dealt to the batches of a stream.

    ``read()`` gives the table as it is now; ``mark()`` the place the source's log has
    reached, as a mapping of ``ts_sec`` and, if the changes have them, ``file, pos, row``.
    ``bounds`` cut ``column`` (``chunk_bounds``) and must stay the same for a ``name``; each
    batch takes ``per_batch`` chunks.  ``options`` go to ``snapshot_envelopes``.
    """

    def __init__(self, store: GraphStore, name: str, *, db: str, table: str, key: list[str], column: str, bounds: list,
                 read: Callable[[], DataFrame], mark: Callable[[], Mapping], per_batch: int = 1, source: str | None = None, **options) -> None:
        self.store, self.home = store, join(store.root, "chunks", name)
        self.db, self.table, self.key, self.column, self.bounds = db, table, key, column, bounds
        self.read, self.mark, self.per_batch, self.source, self.options = read, mark, per_batch, source, options

    def dealt(self, batch: int | None = None) -> dict[int, int]:
        """Chunks by number with their batch, if that is complete or the one asked about."""
        complete, folded = set(self.store.batches()), self.store.folded()
        pairs = (n.split(".") for n in self.store.files.names(self.home))
        return {int(c): int(b) for c, b in pairs if int(b) in complete or int(b) <= folded or int(b) == batch}

    def left(self) -> list[int]:
        """Numbers of the chunks that no complete batch holds."""
        return sorted({*range(len(self.bounds) + 1)} - {*self.dealt()})

    def take(self, batch: int) -> DataFrame | None:
        """Envelopes of the chunks of a batch, None when it has none."""
        dealt = self.dealt(batch)
        mine = sorted(c for c, b in dealt.items() if b == batch)
        if not mine:
            mine = [c for c in range(len(self.bounds) + 1) if c not in dealt][: self.per_batch]
            for chunk in mine:
                self.store.files.mark(join(self.home, f"{chunk}.{batch}"))
        return reduce(DataFrame.unionByName, [self._chunk(c) for c in mine]) if mine else None

    def _chunk(self, number: int) -> DataFrame:
        low = self.mark()  # before anything of the chunk is read
        rows = self.read().where(in_chunk(self.column, self.bounds, number))
        found = snapshot_envelopes(rows, self.db, self.table, self.key, **self.options)
        place = seq_of(F.lit(low["ts_sec"]), *(F.lit(low[p]) if p in low else None for p in ("pos", "row", "file")))
        found = found.withColumn("seq", place).withColumn(ENVELOPE, data_envelope(F.col("data"))).drop("data")
        return found.withColumn("source", F.lit(self.source)) if self.source else found


def with_chunks(batch: DataFrame, chunks: DataFrame | None) -> DataFrame:
    """A batch of changes and the chunks that came with it, which carry the same envelope columns."""
    if chunks is None:
        return batch
    if ENVELOPE not in batch.columns:
        data = F.col("data") if dict(batch.dtypes)["data"] == "string" else F.to_json("data")
        batch = batch.withColumn(ENVELOPE, data_envelope(data)).drop("data")
    return batch.unionByName(chunks, allowMissingColumns=True)
