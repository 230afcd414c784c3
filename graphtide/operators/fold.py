"""Folding change rows into the current state of a label.

The newest change of a key wins.  Where a change has a log position (``_seq.file``
and ``pos``) that decides, as the second of a statement that waited for a lock lies
before its place in the log; without a file the second comes first, then ``pos`` and
``row``.  Ties are broken by "a delete beats anything else" and then by the property
values, so the result depends neither on the arrival order nor on how often a change is
delivered.  Sources that feed one label should not share keys: positions of different
logs compare by file name, which says nothing about time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphtide.plans.spec import DELETED, OP, SEQ, Label, quoted


def with_deleted(changes: DataFrame) -> DataFrame:
    """Replace the operation by the one thing the fold needs to know about it."""
    return changes.withColumn(DELETED, F.col(OP) == "d").drop(OP) if OP in changes.columns else changes


def _order(seq: Column) -> Column:
    """``_seq`` as a value that compares as changes do; ``_seq_of`` undoes it."""
    file = seq.getField("file")
    placed = F.length(file) > 0
    pos, row = seq.getField("pos"), seq.getField("row")
    return F.struct(
        # A longer name is a later file: counters outgrow their leading zeros.
        F.length(file).alias("width"), file.alias("file"), F.when(placed, pos).alias("at"), F.when(placed, row).alias("nth"),
        seq.getField("ts_sec").alias("ts_sec"), F.when(~placed, pos).alias("pos"), F.when(~placed, row).alias("row"),
    )


def _seq_of(order: Column) -> Column:
    get = order.getField
    return F.struct(
        get("ts_sec").alias("ts_sec"), get("file").alias("file"), F.coalesce(get("at"), get("pos")).alias("pos"),
        F.coalesce(get("nth"), get("row")).alias("row"),
    )


def _version(df: DataFrame, keys: Sequence[str]) -> Column:
    """Everything but the key as one comparable value, order first; ``unpacked`` undoes it."""
    rest = [c for c in df.columns if c not in {*keys, SEQ, DELETED}]
    return F.struct(_order(F.col(SEQ)).alias("order"), DELETED, *[quoted(c) for c in rest])


def unpacked(df: DataFrame, label: Label) -> DataFrame:
    """The columns of ``latest_changes`` from keys and ``newest``, a change packed into one value."""
    rows = df.select(*label.key_names, "newest.*").withColumn(SEQ, _seq_of(F.col("order")))
    return rows.select(*state_columns(label), SEQ, DELETED)


def latest_changes(changes: DataFrame, label: Label) -> DataFrame:
    """Newest change per key, deletes included: key, properties, ``_seq``, ``_deleted``.

    One shuffle.  ``max`` combines before it, so a key costs at most one row per
    input task however many changes it has.
    """
    changes = with_deleted(changes)
    newest = changes.groupBy(*label.key_names).agg(F.max(_version(changes, label.key_names)).alias("newest"))
    return unpacked(newest, label)


def state_columns(label: Label) -> list[str]:
    return [*label.key_names, *(quoted(n) for n in label.prop_names)]


def alive(latest: DataFrame, label: Label) -> DataFrame:
    """Vertices or edges that exist: the newest change is no delete."""
    return latest.where(~F.col(DELETED)).select(*state_columns(label))


def before(seq: Column, mark: Column) -> Column:
    """Whether a change stands before a mark (a ``_seq`` too) in the order of changes."""
    return _order(seq) < _order(mark)


def first_of(marks: Sequence[Column]) -> Column:
    """The first of several marks."""
    return _seq_of(F.least(*map(_order, marks))) if len(marks) > 1 else marks[0]


def last_of(marks: Sequence[Column]) -> Column:
    """The last of several marks."""
    return _seq_of(F.greatest(*map(_order, marks))) if len(marks) > 1 else marks[0]


def without_old_tombstones(latest: DataFrame, mark: Column) -> DataFrame:
    """Folded rows without the deletes that stand before the mark: no older change may arrive any more."""
    return latest.where(~(F.col(DELETED) & before(F.col(SEQ), mark)))


def current_state(changes: DataFrame, label: Label) -> DataFrame:
    """Change rows -> the vertices or edges they leave behind."""
    return alive(latest_changes(changes, label), label)


def deleted_keys(changes: DataFrame, label: Label) -> DataFrame:
    """Keys whose newest change is a delete."""
    return latest_changes(changes, label).where(DELETED).select(*label.key_names)


def bootstrap_then_tail(snapshot: DataFrame, tail: DataFrame) -> DataFrame:
    """Snapshot rows followed by changes.

    Snapshot rows carry the lowest order, so a change of the same row wins
    wherever it stands in the tail.
    """
    return snapshot.unionByName(tail)


def merge_latest(base: DataFrame, tail: DataFrame, label: Label, on: Sequence[str] | None = None) -> DataFrame:
    """Two folded tables into one; each has a key at most once.

    A full outer join on ``on`` (the whole key by default): when ``base`` is
    bucketed by it, only ``tail`` is shuffled.  A rank that is always 0 must not
    be among ``on``: the optimiser would fold it out of the join.
    """
    keys = list(on or label.key_names)
    old = base.select(*keys, _version(base, label.key_names).alias("old"))
    new = tail.select(*base.columns).select(*keys, _version(base, label.key_names).alias("new"))
    newest = old.join(new, keys, "full_outer").select(*keys, F.greatest("old", "new").alias("newest"))
    for constant in label.key_names:
        if constant not in keys:
            newest = newest.withColumn(constant, F.lit(0).cast("bigint"))
    return unpacked(newest, label)


def state_stream(changes: DataFrame, label: Label) -> DataFrame:
    """The fold as a streaming aggregation (update mode).

    Keeps every key in the state store for ever, tombstones included; see
    ``streaming.view``.  Use ``streaming.store`` for large key sets.
    """
    return latest_changes(changes, label)
