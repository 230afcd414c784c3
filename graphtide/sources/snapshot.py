"""Snapshots: the rows a table holds before its changes are followed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType

from graphtide.operators.normalize import render_row, render_value
from graphtide.plans.spec import AUTO, OP, RANK, SEQ, Label, quoted
from graphtide.sources.envelopes import seq_of


def jdbc_options(label: Label, url: str, *, split_column: str | None = None, lower: object = None,
                 upper: object = None, partitions: int = 1, fetch_rows: int = 10_000,
                 credentials: Mapping[str, str] | None = None) -> dict[str, str]:
    """Reader options for the snapshot of a label's table, mapped columns only.

    ``split_column`` with its bounds makes Spark read ``partitions`` ranges in
    parallel; the bounds only place the cuts, rows outside them are read too.
    """
    columns = ", ".join(quoted(c) for c in label.slots)
    options = {
        "url": url,
        "dbtable": f"(SELECT {columns} FROM {quoted(label.db)}.{quoted(label.table)}) snapshot",
        "fetchsize": str(fetch_rows),
        **(credentials or {}),
    }
    if split_column is not None:
        if lower is None or upper is None:
            raise ValueError("a split column needs a lower and an upper bound")
        if split_column not in label.slots:
            raise ValueError(f"{split_column!r} is not a mapped column of {label.label}")
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc_snapshot(spark: SparkSession, label: Label, url: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(label, url, **kwargs)).load()


def snapshot_rows(table: DataFrame, label: Label, types: Mapping[str, str] | None = None, **options) -> DataFrame:
    """Table rows as change rows of a label: op ``r``, ordered before every change.

    Values are rendered as ``normalize.render_row`` does (with the same logical
    ``types`` and options), so a row reads alike in snapshot and tail.  Declared
    columns are then cast and skip the envelope; fractions of undeclared ones take
    its way through JSON, which settles how they are printed.
    """
    kinds = {f.name: f.dataType for f in table.schema.fields}

    def typed(column: str) -> Column:
        kind, declared = kinds[column], label.column_types[column]
        value = render_value(F.col(quoted(column)), kind, (types or {}).get(column), **options)
        if declared == AUTO and isinstance(kind, (DecimalType, FractionalType)):
            return F.try_variant_get(F.try_parse_json(F.to_json(F.struct(value.alias("v")))), "$.v", "string")
        return value.cast(label.type_of(column))

    keys = []
    for name, ref in label.keys.items():
        if name == RANK:
            rank = F.lit(None) if ref is None else F.col(quoted(ref.column))
            keys.append(F.coalesce(rank.cast("bigint"), F.lit(0).cast("bigint")).alias(name))
        else:
            keys.append(typed(ref.column).alias(name))
    props = [typed(p.column).alias(p.name) for p in label.props]
    rows = table.select(*keys, *props, F.lit("r").alias(OP), seq_of(F.lit(0)).alias(SEQ))
    return rows.dropna(subset=label.key_names)


def snapshot_envelopes(table: DataFrame, db: str, name: str, key: list[str], types: Mapping[str, str] | None = None,
                       **options) -> DataFrame:
    """Table rows as decoded envelopes, for a table that feeds several labels; rendered like changes."""
    image = F.struct(*[F.col(quoted(c)) for c in table.columns])
    return table.select(
        F.lit("r").alias("op"),
        F.lit(0).cast("bigint").alias("ts_sec"),
        F.lit(db).alias("db"),
        F.lit(name).alias("table"),
        F.array(*[F.lit(c) for c in key]).alias("key"),
        F.to_json(render_row(image, table.schema, types, **options)).alias("data"),
        F.lit(None).cast("bigint").alias("parse_time"),
        seq_of(F.lit(0)).alias("seq"),
    )


