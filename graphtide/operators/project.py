"""Projection of row images onto vertices and edges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphtide.operators.route import route_table
from graphtide.plans.spec import OP, RANK, SEQ, EdgeMap, GraphSpec, Label, VertexMap, quoted
from graphtide.sources.envelopes import ENVELOPE, decode_envelopes

BAD = "_bad"


def project_slots(changes: DataFrame, label: Label, carry: Sequence[str] = ()) -> DataFrame:
    """Row image as typed columns in slot order; a column the image lacks is null.

    A value that does not fit its declared type leaves the image's text in ``_bad``.
    ``changes`` are envelopes of the label's table, whose row image is a struct
    ``data``, JSON text ``data``, or still inside the record (``envelope``).
    The result also has the operation, the ordering column and those to ``carry``.
    """
    control = [F.col("op").alias(OP), F.col("seq").alias(SEQ)]
    bad = F.lit(None).cast("string")
    if "data" in changes.columns and isinstance(changes.schema["data"].dataType, T.StructType):
        row = F.col("data")
        present = set(changes.schema["data"].dataType.names)
    else:
        own = "data" in changes.columns
        text = F.col("data") if own else F.col(ENVELOPE)
        schema = label.data_ddl if own else f"data: struct<{label.data_ddl}>"
        parsed = F.from_json(text, f"struct<{schema}, {BAD}: string>", {"columnNameOfCorruptRecord": BAD})
        # As in decode_envelopes, a generator keeps the parser from being copied.
        changes = changes.select(*dict.fromkeys(["op", "seq", *carry]), F.explode(F.array(parsed)).alias("parsed"))
        row, present = F.col("parsed") if own else F.col("parsed.data"), set(label.slots)
        bad = F.col("parsed").getField(BAD)
    slots = [
        (row.getField(c) if c in present else F.lit(None)).cast(label.type_of(c)).alias(c) for c in label.slots
    ]
    return changes.select(*slots, *control, bad.alias(BAD), *carry)


def map_columns(slots: DataFrame, label: Label) -> DataFrame:
    """Slots to key and property columns, bound by name.

    A missing rank is rank 0.  A row without an id, source or destination can
    not be stored, and one with a value of the wrong type would store a null; both
    are left out and ``rejected_slots`` returns them.  A delete needs its key only.
    """
    if BAD in slots.columns:
        slots = slots.where(F.col(BAD).isNull() | (F.col(OP) == "d"))
    return _mapped(slots, label).dropna(subset=label.key_names)


def rejected_slots(slots: DataFrame, label: Label) -> DataFrame:
    """Projected changes that ``map_columns`` leaves out, with the ``reason``: ``bad_value`` or ``null_key``."""
    missing = F.lit(False)
    for name, ref in label.keys.items():
        if name != RANK:
            missing = missing | F.col(quoted(ref.column)).isNull()
    spoiled = F.col(BAD).isNotNull() & (F.col(OP) != "d")
    return slots.withColumn("reason", F.when(spoiled, "bad_value").when(missing, "null_key")).where("reason IS NOT NULL")


def null_keys(slots: DataFrame, label: Label) -> DataFrame:
    """Projected changes that name no vertex or edge."""
    missing = F.lit(False)
    for name, ref in label.keys.items():
        if name != RANK:
            missing = missing | F.col(quoted(ref.column)).isNull()
    return slots.where(missing)


def _mapped(slots: DataFrame, label: Label) -> DataFrame:
    keys = []
    for name, ref in label.keys.items():
        if name == RANK:
            rank = F.lit(None) if ref is None else F.col(quoted(ref.column))
            keys.append(F.coalesce(rank.cast("bigint"), F.lit(0).cast("bigint")).alias(name))
        else:
            keys.append(F.col(quoted(ref.column)).alias(name))
    props = [F.col(quoted(p.column)).alias(p.name) for p in label.props]
    return slots.select(*keys, *props, OP, SEQ)


def to_vertices(changes: DataFrame, tag: VertexMap) -> DataFrame:
    """Envelopes of the tag's table -> ``_vid``, properties, ``_op``, ``_seq``."""
    return map_columns(project_slots(changes, tag), tag)


def to_edges(changes: DataFrame, edge: EdgeMap) -> DataFrame:
    """Envelopes of the edge's table -> ``_src, _dst, _rank``, properties, ``_op``, ``_seq``."""
    return map_columns(project_slots(changes, edge), edge)


def label_changes(feed: DataFrame, label: Label) -> DataFrame:
    """Decoded feed of any tables -> change rows of one label."""
    return map_columns(project_slots(route_table(feed, label), label), label)


def decode_label(feed: DataFrame, label: Label, col: str = "value") -> DataFrame:
    """Envelope text -> change rows of one label, parsing each record once.

    For a feed of the label's table alone (a topic per table); records of other
    tables are skipped, at the price of parsing them.
    """
    return label_changes(decode_envelopes(feed, col, data_ddl=label.data_ddl), label)


def graph_changes(feed: DataFrame, spec: GraphSpec, label: Label) -> DataFrame:
    """Decoded feed -> change rows of a label from all tables that feed it."""
    return reduce(DataFrame.unionByName, [label_changes(feed, m) for m in spec.mappings(label)])


def change_ddl(label: Label) -> str:
    """Schema of a label's change rows, without the operation and the order."""
    return ", ".join(f"{quoted(n)} {t}" for n, t in label.shape.items())
