"""The current graph as the state of a stream.

A keyed state operator keeps the newest change of every key in Spark's RocksDB state
store; nothing else is written.  The view is read back from the checkpoint with Spark's own
state reader, at any time and from any session, without the stream running.  A restart goes
on from the same state.

Meant for labels whose keys fit the state stores of the cluster (a few hundred million rows);
``streaming.store`` keeps larger ones in versions.  A row of state holds the key, the
order and the properties; a deleted key keeps its key and order only, so that an older
change that comes late cannot revive it.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from graphtide.operators import fold, project
from graphtide.plans.spec import OP, GraphSpec, Label, quoted
from graphtide.sources.envelopes import decode_envelopes
from graphtide.streaming.files import Files, join
from graphtide.streaming.sync import DEFAULT_TRIGGER

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_SETTINGS = {
    _PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A batch uploads its changes, not the files of the whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


class StateSize(NamedTuple):
    """Keys in the state (deleted ones too), how many of them are deleted, and bytes of its files in the checkpoint."""

    keys: int
    deleted: int
    bytes: int

    @property
    def bytes_per_key(self) -> float:
        return self.bytes / max(1, self.keys)


class StateView:
    """The vertices or edges of a label, kept by a stream with this checkpoint."""

    def __init__(self, spark: SparkSession, checkpoint: str, spec: GraphSpec, label: Label | str) -> None:
        self.spark, self.checkpoint, self.spec = spark, checkpoint, spec
        self.label = spec.label(label) if isinstance(label, str) else label

    def start(self, feed: DataFrame, *, decode: Callable[[DataFrame], DataFrame] | None = decode_envelopes, available_now: bool = False,
              trigger: str = DEFAULT_TRIGGER, publish: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
        """Start the stream; ``publish`` gets the rows that a batch changed (``_deleted`` marks the gone ones) and its number."""
        decoded = feed if decode is None else decode(feed)
        changes = project.graph_changes(decoded, self.spec, self.label)
        slim = {p: F.when(F.col(OP) != "d", F.col(quoted(p))) for p in self.label.prop_names}
        newest = fold.state_stream(changes.withColumns(slim) if slim else changes, self.label)
        writer = newest.writeStream.outputMode("update").option("checkpointLocation", self.checkpoint)
        writer = writer.foreachBatch(publish) if publish else writer.format("noop")
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
        # A query copies the settings when it starts; the session keeps its own.
        before = {k: self.spark.conf.get(k, None) for k in _SETTINGS}
        try:
            for k, v in _SETTINGS.items():
                self.spark.conf.set(k, v)
            return writer.start()
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)

    def latest(self) -> DataFrame:
        """Newest change of every key, deleted ones included, as of the last complete batch."""
        rows = self.spark.read.format("statestore").load(self.checkpoint)
        return fold.unpacked(rows.select("key.*", F.col("value.max").alias("newest")), self.label)

    def state(self) -> DataFrame:
        """Current vertices or edges, as of the last complete batch."""
        return fold.alive(self.latest(), self.label)

    def size(self) -> StateSize:
        row = self.latest().agg(F.count("*").alias("keys"), F.count_if("_deleted").alias("deleted")).head()
        return StateSize(row["keys"], row["deleted"], Files(self.spark).size(join(self.checkpoint, "state")))


def view_available(feed: DataFrame, view: StateView, **kwargs) -> None:
    """Take in everything that is there, then stop."""
    view.start(feed, available_now=True, **kwargs).awaitTermination()
