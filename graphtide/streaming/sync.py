"""Continuous synchronisation: envelopes in, graph tables up to date."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from graphtide.sources.envelopes import decode_envelopes
from graphtide.streaming.chunks import ChunkedSnapshot, with_chunks
from graphtide.streaming.files import join
from graphtide.streaming.store import GraphStore
from graphtide.streaming.watch import Warnings

# Fixed value: flush interval of the sinks.
DEFAULT_TRIGGER = "500 milliseconds"


def start_sync(feed: DataFrame, store: GraphStore, checkpoint: str, *, available_now: bool = False,
               trigger: str = DEFAULT_TRIGGER, decode: Callable[[DataFrame], DataFrame] | None = decode_envelopes,
               compact_every: int = 1000, name: str | None = None, watch: Warnings | None = None,
               chunks: ChunkedSnapshot | None = None) -> StreamingQuery:
    """Start the query that keeps ``store`` in step with ``feed``.

    ``feed`` is a stream of envelope text, or of anything ``decode`` turns into
    envelope columns (None: it has them already).  Restarting with the same
    ``checkpoint`` goes on where the last run stopped; with a new one the batches
    are numbered on from those the store has.  ``compact_every`` folds the log and
    drops what is folded each time that many batches have come in (0: never).
    ``watch`` counts key and column warnings as the changes pass.  ``chunks`` reads a
    table beside its changes, some of it with each batch (a batch needs a change to begin).

    There is no watermark: order is settled by the fold, at any delay.  A
    failure is raised by the returned query, not swallowed.
    """
    changes = feed if decode is None else decode(feed)
    if watch:
        changes = watch.observe(changes)
        watch.register(store.spark)
    owner, base = _claim(store, checkpoint)

    def apply(batch: DataFrame, batch_id: int) -> None:
        number = base + batch_id + 1  # number 0 is the snapshot
        store.append(with_chunks(batch, chunks.take(number)) if chunks else batch, number, owner)
        if compact_every and (batch_id + 1) % compact_every == 0:
            store.compact_all()
            store.vacuum()

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


def _claim(store: GraphStore, checkpoint: str) -> tuple[str, int]:
    """Who writes with this checkpoint, and the number its batches count from.

    Both stand in the name of a marker beside the checkpoint, made at the first
    start, so a checkpoint that was deleted is a new writer.
    """
    home = join(checkpoint, "writer")
    found = [n for n in store.files.names(home) if n.startswith("owner-")]
    if not found:
        found = [f"owner-{uuid.uuid4().hex}-{max([0, *store.batches()])}"]
        store.files.mark(join(home, found[0]))
    _, owner, base = found[0].split("-")
    return owner, int(base)


def sync_available(feed: DataFrame, store: GraphStore, checkpoint: str, **kwargs) -> None:
    """Take in everything that is there, then stop."""
    start_sync(feed, store, checkpoint, available_now=True, **kwargs).awaitTermination()


def bootstrap(store: GraphStore, snapshot: DataFrame) -> None:
    """Load a snapshot (decoded envelopes with op ``r``) as the batch before all streamed ones."""
    store.append(snapshot, 0)


