"""Flat JSON envelopes: one change of one source row per record.

    {"op": "u", "ts_sec": 1700000000, "db": "shop", "table": "article",
     "key": ["sku"], "data": {"sku": "A-7", "price": 12.5}, "parse_time": 1700000003,
     "seq": {"ts_sec": 1700000000, "file": "log.000021", "pos": 512, "row": 0}}

``op`` is r (snapshot), c, u or d.  ``data`` differs per table, so the record is
kept as text until the label that reads it is known.  ``seq`` is the total order of the
changes of a source (see ``operators.fold``); a feed without it falls back to ``ts_sec`` and,
from a topic, the offset.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphtide.plans.spec import quoted

SEQ_TYPE = "struct<ts_sec: bigint, file: string, pos: bigint, row: int>"
ENVELOPE_COLUMNS = ("op", "ts_sec", "db", "table", "key", "data", "parse_time", "seq")
BAD_JSON = "bad_json"
OFFSET = "_offset"  # place in a topic's partition; orders the changes of a feed without seq
ENVELOPE = "envelope"
FILE_RECORDS = 1_000_000  # of a written feed: some 50 MB


def seq_of(ts_sec: Column, pos: Column | None = None, row: Column | None = None,
           file: Column | None = None) -> Column:
    """Ordering struct; parts that a source does not have are the lowest value."""
    return F.struct(
        ts_sec.cast("bigint").alias("ts_sec"),
        (F.lit("") if file is None else file).cast("string").alias("file"),
        (F.lit(0) if pos is None else pos).cast("bigint").alias("pos"),
        (F.lit(0) if row is None else row).cast("int").alias("row"),
    )


def decode_envelopes(df: DataFrame, col: str = "value", *, data_ddl: str | None = None) -> DataFrame:
    """Parse the head of envelope text; other columns of ``df`` are kept.

    The whole record stays in ``envelope``, from which a label later parses the
    columns it maps.  Cutting ``data`` out as text instead would print its
    numbers anew and lose digits.  With ``data_ddl`` (schema of the row) the row
    is parsed in the same pass, as struct ``data``; that is meant for a feed of
    a single table.  A record that is no envelope has its text in ``bad_json``.
    """
    data = f"data struct<{data_ddl}>, " if data_ddl else ""
    schema = (
        f"op string, ts_sec bigint, db string, `table` string, `key` array<string>, {data}"
        f"parse_time bigint, seq {SEQ_TYPE}, {BAD_JSON} string"
    )
    text = F.col(quoted(col))
    parsed = F.from_json(text, schema, {"columnNameOfCorruptRecord": BAD_JSON})
    kept = [F.col(quoted(c)) for c in df.columns if c != col]
    if not data_ddl:
        kept.append(text.alias(ENVELOPE))
    # inline() keeps later filters above the parser.  Selecting from the struct
    # instead would let the optimiser copy the parser into every pushed filter.
    out = df.select(*kept, F.inline(F.array(parsed)))
    place = F.col(OFFSET) if OFFSET in df.columns else None
    return out.withColumn("seq", F.coalesce("seq", seq_of(F.col("ts_sec"), place)))


def encode_envelopes(df: DataFrame, col: str = "value") -> DataFrame:
    """Envelope columns to JSON text; null fields are left out.

    ``data`` may be a struct or JSON text.  Columns that are not part of the
    envelope (such as ``source``) are kept beside the text.
    """
    parts = [c for c in ENVELOPE_COLUMNS if c in df.columns]
    kept = [F.col(quoted(c)) for c in df.columns if c not in (*ENVELOPE_COLUMNS, ENVELOPE, BAD_JSON)]
    if ENVELOPE in df.columns:
        return df.select(*kept, F.col(ENVELOPE).alias(col))
    if not isinstance(df.schema["data"].dataType, T.StringType):
        return df.select(*kept, F.to_json(F.struct(*parts)).alias(col))
    # Text is spliced in as it is: re-parsing could change number formats.
    head = F.to_json(F.struct(*[c for c in parts if c != "data"]))
    spliced = F.concat(data_envelope(F.col("data"), close=","), F.substring(head, F.lit(2), F.length(head)))
    return df.select(*kept, F.coalesce(spliced, head).alias(col))


def data_envelope(data: Column, close: str = "}") -> Column:
    """Envelope text that holds nothing but the row image."""
    return F.concat(F.lit('{"data":'), data, F.lit(close))


def union_sources(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """One DataFrame of several named sources, told apart by column ``source``."""
    if not feeds:
        raise ValueError("no source given")
    tagged = [df.withColumn("source", F.lit(name)) for name, df in feeds.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def read_feed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Batch of envelope text files, one record per line."""
    return spark.read.text(path)


def write_feed(text: DataFrame, path: str) -> None:
    """Append envelope text to a feed, compressed; ``read_feed`` and ``stream_feed`` read it as it is.

    A compressed file is read by one task, so none holds more than ``FILE_RECORDS``.
    """
    text.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def stream_feed(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None) -> DataFrame:
    """Envelope text files as a stream; new files are picked up as they arrive."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def stream_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Envelopes from a Kafka topic (needs Spark's Kafka connector on the class path)."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(F.col("value").cast("string").alias("value"), F.col("offset").alias(OFFSET))
