"""Routing: which labels a change concerns, and what happens to the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphtide.plans.spec import GraphSpec, Label
from graphtide.sources.envelopes import BAD_JSON

INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"
ROUTE_DDL = "source string, db string, `table` string, label string, kind string, index_columns array<string>"
_ON = ["source", "db", "table"]


def op_class(op: Column) -> Column:
    """INSERT for r and c, UPDATE for u, DELETE for d, null for anything else."""
    return F.when(op.isin("r", "c"), INSERT).when(op == "u", UPDATE).when(op == "d", DELETE)


def with_source(df: DataFrame) -> DataFrame:
    return df if "source" in df.columns else df.withColumn("source", F.lit("default"))


def routes(spark: SparkSession, spec: GraphSpec) -> DataFrame:
    """One row per label: the table it reads and the columns that identify it."""
    rows = [(x.source, x.db, x.table, x.label, x.kind, x.index_columns) for x in spec.labels]
    return spark.createDataFrame(rows, ROUTE_DDL)


def _tables(spark: SparkSession, spec: GraphSpec) -> DataFrame:
    named = sorted({(x.source, x.db, x.table) for x in spec.labels})
    # As many rows as the mapping has tables; the mapping is an object of the driver anyway.
    return F.broadcast(spark.createDataFrame(named, "source string, db string, `table` string"))


def scope_feed(feed: DataFrame, spec: GraphSpec) -> DataFrame:
    """Changes of the tables that some label reads."""
    return with_source(feed).join(_tables(feed.sparkSession, spec), _ON, "left_semi")


def route_table(feed: DataFrame, label: Label, op: str | None = None) -> DataFrame:
    """Changes of one label's table with a known operation, optionally of one class."""
    feed = with_source(feed)
    at_home = (F.col("source") == label.source) & (F.col("db") == label.db) & (F.col("table") == label.table)
    known = op_class(F.col("op")).isNotNull() if op is None else op_class(F.col("op")) == op
    return feed.where(at_home & known)


def fan_out(feed: DataFrame, spec: GraphSpec) -> DataFrame:
    """Every (change, label) pair in one pass over the feed.

    Adds ``label``, ``kind``, ``index_columns`` and ``op_class``.
    """
    known = with_source(feed).withColumn("op_class", op_class(F.col("op"))).where("op_class IS NOT NULL")
    return known.join(F.broadcast(routes(feed.sparkSession, spec)), _ON, "inner")


def unrouted(feed: DataFrame, spec: GraphSpec) -> DataFrame:
    """Changes of tables that no label reads."""
    return with_source(feed).join(_tables(feed.sparkSession, spec), _ON, "left_anti")


def judge(feed: DataFrame, spec: GraphSpec) -> DataFrame:
    """``fan_out`` that keeps the changes no label takes, with the ``reason``.

    ``bad_json``: no envelope; ``bad_op``: the operation is none of r, c, u, d;
    ``unrouted``: no label reads the table.  Routed changes have a null reason.
    """
    feed = with_source(feed).withColumn("op_class", op_class(F.col("op")))
    feed = feed.withColumn("_known", F.col("op_class").isNotNull())
    plan = routes(feed.sparkSession, spec).withColumn("_known", F.lit(True))
    bad = F.col(BAD_JSON).isNotNull() if BAD_JSON in feed.columns else F.lit(False)
    reason = F.when(F.col("label").isNull(), F.when(bad, "bad_json").when(~F.col("_known"), "bad_op")
                    .otherwise("unrouted"))
    return feed.join(F.broadcast(plan), [*_ON, "_known"], "left").withColumn("reason", reason).drop("_known")


def judge_tables(feed: DataFrame, spec: GraphSpec) -> DataFrame:
    """``judge`` without the labels: every change once, with a null reason if some label reads its table."""
    feed = with_source(feed)
    tables = _tables(feed.sparkSession, spec).withColumn("_read", F.lit(True))
    bad = F.col(BAD_JSON).isNotNull() if BAD_JSON in feed.columns else F.lit(False)
    reason = (
        F.when(bad, "bad_json").when(op_class(F.col("op")).isNull(), "bad_op").when(F.col("_read").isNull(), "unrouted")
    )
    return feed.join(F.broadcast(tables), _ON, "left").withColumn("reason", reason).drop("_read")


def rejects(feed: DataFrame, spec: GraphSpec) -> DataFrame:
    """Changes that reach no label, with the ``reason`` (see ``judge``)."""
    return judge(feed, spec).where("reason IS NOT NULL").drop("label", "kind", "index_columns", "op_class")


def key_coverage(routed: DataFrame) -> DataFrame:
    """Routed changes whose key lacks a column that identifies the label.

    Takes the output of ``fan_out`` and adds ``missing``.  A change without a
    key is not judged.
    """
    missing = F.array_except("index_columns", "key")
    return routed.withColumn("missing", missing).where("size(missing) > 0")


def key_coverage_counts(routed: DataFrame) -> DataFrame:
    """Number of warnings per label and column."""
    warned = key_coverage(routed).select("label", F.explode("missing").alias("missing"))
    return warned.groupBy("label", "missing").agg(F.count("*").alias("changes"))


def observed(routed: DataFrame, name: str) -> DataFrame:
    """Count changes and key warnings while they pass; read them from a query listener."""
    lacking = F.size(F.array_except("index_columns", "key")) > 0
    return routed.observe(
        name,
        F.count(F.lit(1)).alias("changes"),
        F.count_if(F.col("op_class") == INSERT).alias("inserts"),
        F.count_if(F.col("op_class") == UPDATE).alias("updates"),
        F.count_if(F.col("op_class") == DELETE).alias("deletes"),
        F.count_if(lacking).alias("key_warnings"),
    )
