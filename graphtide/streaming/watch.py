"""Warnings of a running sync, counted while the changes pass.

The counts are observed metrics of the stream, so they cost no pass of their own; a
listener adds them up from batch to batch.  A batch that a restart repeats replaces its first
counts.  Records are counted as delivered, twice if they come twice.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from graphtide.operators.route import op_class, with_source
from graphtide.plans.spec import GraphSpec
from graphtide.sources.envelopes import ENVELOPE

METRICS = "graphtide_warnings"
UNKEYED, ABSENT, CHANGES = "key", "absent", "changes"


@dataclass
class _Totals:
    """Counts of the batches before the last one, and of that one."""

    before: dict[str, int] = field(default_factory=dict)
    batch: int = -1
    last: dict[str, int] = field(default_factory=dict)

    def add(self, batch: int, counts: dict[str, int]) -> None:
        if batch != self.batch:
            self.before, self.batch = self.sum(), batch
        self.last = counts

    def sum(self) -> dict[str, int]:
        return {k: self.before.get(k, 0) + self.last.get(k, 0) for k in {**self.before, **self.last}}


class Warnings(StreamingQueryListener):
    """For each mapping: changes, changes whose key lacks an index column, and changes without a mapped column.

    A column is absent if the record has no value for it, be it null or not sent at all;
    one that is absent from all changes of a table (``unseen``) is most likely misspelt.
    Give one object to ``start_sync(watch=...)``; it is registered with the session there.
    """

    def __init__(self, spec: GraphSpec) -> None:
        self.spec = spec
        self._names = [
            (kind, label.label, column)
            for label in spec.labels
            for kind, columns in ((CHANGES, [""]), (UNKEYED, label.index_columns), (ABSENT, dict.fromkeys(label.slots)))
            for column in columns
        ]
        self._totals: dict[str, _Totals] = {}
        self._ended: set[str] = set()
        self._turn = threading.Condition()
        self._registered = False

    def register(self, spark: SparkSession) -> None:
        """Listen to the session's queries; once, however many of them are watched."""
        if not self._registered:
            spark.streams.addListener(self)
            self._registered = True

    def unregister(self, spark: SparkSession) -> None:
        if self._registered:
            spark.streams.removeListener(self)
            self._registered = False

    # -- in the stream -----------------------------------------------------------

    def observe(self, feed: DataFrame) -> DataFrame:
        """The decoded feed with the counts as observed metrics."""
        known = with_source(feed)
        tables = list(dict.fromkeys((x.source, x.db, x.table) for x in self.spec.labels))
        table = F.lit(-1)
        for i, (source, db, name) in enumerate(tables):
            table = F.when((F.col("source") == source) & (F.col("db") == db) & (F.col("table") == name), i).otherwise(table)
        # Found once for each record; the many counts compare a number first.
        found = {"_table": F.when(op_class(F.col("op")).isNotNull(), table).otherwise(-1), "_key": F.col("key"), "_present": _present(feed)}
        conditions = []
        for label in self.spec.labels:
            home = F.col("_table") == tables.index((label.source, label.db, label.table))
            conditions.append(home)
            # What a null key or image holds is null too and not counted.
            conditions += [home & ~F.array_contains("_key", c) for c in label.index_columns]
            conditions += [home & ~F.array_contains("_present", c) for c in dict.fromkeys(label.slots)]
        counts = [F.count_if(c).alias(f"n{i}") for i, c in enumerate(conditions)]
        return known.withColumns(found).observe(METRICS, *counts).select(*feed.columns)

    # -- in the listener ---------------------------------------------------------

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(METRICS)
        if row is not None:
            with self._turn:
                self._totals.setdefault(str(event.progress.id), _Totals()).add(event.progress.batchId, row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._turn:
            self._ended.add(str(event.runId))
            self._turn.notify_all()

    def settle(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until the counts of a query that has stopped are complete; events arrive behind it."""
        with self._turn:
            if not self._turn.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no news of the end of query {query.runId}")

    # -- results -----------------------------------------------------------------

    def counts(self) -> dict[tuple[str, str, str], int]:
        """Counts by (kind, label, column) of all queries that were watched."""
        out: dict[tuple[str, str, str], int] = {}
        with self._turn:
            for totals in self._totals.values():
                for name, n in totals.sum().items():
                    at = self._names[int(name[1:])]
                    out[at] = out.get(at, 0) + n
        return out

    def _frame(self, spark: SparkSession, kind: str, column: str) -> DataFrame:
        rows = [(label, c, n) for (k, label, c), n in sorted(self.counts().items()) if k == kind and n]
        return spark.createDataFrame(rows, f"label string, {column} string, changes bigint")

    def missing(self, spark: SparkSession) -> DataFrame:
        """(label, missing, changes): as ``route.key_coverage_counts``, from the running sync."""
        return self._frame(spark, UNKEYED, "missing")

    def absent(self, spark: SparkSession) -> DataFrame:
        """(label, column, changes) of changes that have no value for a mapped column."""
        return self._frame(spark, ABSENT, "column")

    def unseen(self) -> list[tuple[str, str]]:
        """Mapped columns that no change of their table had so far."""
        counts = self.counts()
        return sorted((label, c) for (kind, label, c), n in counts.items() if kind == ABSENT and n and n == counts[CHANGES, label, ""])


def _present(feed: DataFrame) -> Column:
    """Names of the columns that a record has a value for."""
    kinds = dict(feed.dtypes)
    if "data" in kinds:
        data = F.to_json("data") if kinds["data"].startswith("struct") else F.col("data")
        values = F.from_json(data, "map<string,variant>")
    else:
        data = F.get_json_object(F.col(ENVELOPE), "$.data")
        values = F.from_json(F.col(ENVELOPE), "data map<string,variant>").getField("data")
    # Values are read in place; printing each as text costs more than the decoding of the record.
    # That is left for images with a value that is no variant, such as an object that repeats a name.
    seen = F.map_keys(F.map_filter(values, lambda _, v: ~F.coalesce(F.is_variant_null(v), F.lit(True))))
    return F.coalesce(seen, F.map_keys(F.map_filter(F.from_json(data, "map<string,string>"), lambda _, v: v.isNotNull())))
