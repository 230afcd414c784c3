"""Raw change records to flat envelopes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphtide.functions import geometry, render
from graphtide.plans.spec import quoted
from graphtide.sources.envelopes import seq_of
from graphtide.sources.raw import OFFSET_TYPE

# Logical types a plain number or text column may carry (public schema names of
# the change-data-capture format) and the short names used in ``types``.
LOGICAL_TYPES = {
    "io.debezium.time.Date": "date",
    "io.debezium.time.Timestamp": "timestamp",
    "io.debezium.time.MicroTimestamp": "micro_timestamp",
    "io.debezium.time.NanoTimestamp": "nano_timestamp",
    "io.debezium.time.ZonedTimestamp": "zoned_timestamp",
    "io.debezium.time.MicroTime": "micro_time",
    "io.debezium.time.NanoTime": "nano_time",
    "io.debezium.data.geometry.Geometry": "geometry",
}
TEMPORAL = tuple(v for v in LOGICAL_TYPES.values() if v != "geometry")
_UNITS = {"timestamp": 10**3, "micro_timestamp": 10**6, "nano_timestamp": 10**9,
          "micro_time": 10**6, "nano_time": 10**9}


@dataclass(frozen=True)
class RawTable:
    """A captured table: schema of its rows, of its key (None: no primary key) and logical types by column."""

    row: str
    key: str | None = None
    types: Mapping[str, str] | None = None


def pick_image(op: Column, before: Column, after: Column) -> Column:
    """Row image a change speaks about: the old one for a delete, else the new one."""
    return F.when(op == "d", before).otherwise(after)


def split_origin(schema_name: Column) -> tuple[Column, Column]:
    """``server.db.table.Envelope`` -> (db, table)."""
    parts = F.split(schema_name, r"\.")
    return F.get(parts, F.lit(1)), F.get(parts, F.lit(2))


def key_columns(df: DataFrame, col: str = "key") -> Column:
    """Names of the key columns: fields of a key struct, or keys of a key map.

    Null when the record (or the whole table) has no key.
    """
    if col not in df.columns:
        return F.lit(None).cast("array<string>")
    kind = df.schema[col].dataType
    key = F.col(quoted(col))
    if isinstance(kind, T.StructType):
        return F.when(key.isNotNull(), F.array(*[F.lit(n) for n in kind.names]))
    if isinstance(kind, T.MapType):
        return F.map_keys(key)
    if isinstance(kind, T.ArrayType):
        return key
    if isinstance(kind, T.NullType):
        return F.lit(None).cast("array<string>")
    raise TypeError(f"a key is a struct, a map or a list of names, not {kind.simpleString()}")


def parse_time(now: int | Column | None = None) -> Column:
    """Epoch second of processing; ``now`` fixes it, e.g. for a repeatable run."""
    if now is None:
        return F.unix_timestamp().cast("bigint")
    return (now if isinstance(now, Column) else F.lit(now)).cast("bigint")


def render_value(value: Column, kind: T.DataType, logical: str | None = None, *, tz: str = "UTC",
                 time_pattern: str = "HH:mm:ss", temporal: str = "render") -> Column:
    """Envelope form of a column value.

    Numbers, booleans and text pass through, binary becomes text of signed
    bytes, dates and times become ISO text.  ``temporal='raw'`` passes the
    numbers behind logical dates and times through.
    """
    logical = LOGICAL_TYPES.get(logical, logical)
    if logical is not None and logical not in LOGICAL_TYPES.values():
        raise ValueError(f"unknown logical type {logical!r}")
    if logical in TEMPORAL:
        if temporal == "raw":
            return value
        if logical == "zoned_timestamp":
            if not isinstance(kind, T.StringType):
                raise TypeError(f"a zoned timestamp is text, not {kind.simpleString()}")
            return render.iso_zoned(value, tz)
        if not isinstance(kind, T.IntegralType):
            raise TypeError(f"{logical} is an epoch count, not {kind.simpleString()}")
        if logical == "date":
            return render.iso_date(value)
        if logical.endswith("_time"):
            # A 32-bit time of day counts milliseconds, whatever its declared unit.
            unit = _UNITS[logical] if isinstance(kind, T.LongType) else 10**3
            return render.clock_time(value, unit, time_pattern)
        return render.iso_epoch(value, _UNITS[logical])
    if logical == "geometry":
        return geometry.wkb_text(value if isinstance(kind, T.BinaryType) else value.getField("wkb"))
    if isinstance(kind, T.BinaryType):
        return render.signed_bytes(value)
    if isinstance(kind, T.DateType):
        return value.cast("string")
    if isinstance(kind, T.TimestampNTZType):
        return render.iso_timestamp_ntz(value)
    if isinstance(kind, T.TimestampType):
        return render.iso_instant(value, tz)
    if isinstance(kind, (T.NumericType, T.StringType, T.BooleanType, T.NullType)):
        return value
    raise TypeError(f"no envelope form for {kind.simpleString()}")


def render_row(image: Column, schema: T.StructType, types: Mapping[str, str] | None = None,
               **options) -> Column:
    """Struct of rendered values with the field names of ``schema``."""
    types = types or {}
    unknown = sorted(set(types) - set(schema.names))
    if unknown:
        raise ValueError(f"logical types for columns that do not exist: {unknown}")
    return F.struct(*[
        render_value(image.getField(f.name), f.dataType, types.get(f.name), **options).alias(f.name)
        for f in schema.fields
    ])


def normalize_changes(raw: DataFrame, types: Mapping[str, str] | None = None, *,
                      now: int | Column | None = None, track_key_moves: Sequence[str] = (),
                      as_text: bool = True, **options) -> DataFrame:
    """Raw change records of one table to envelope columns.

    ``raw`` has ``schema_name, op, before, after, source_offset`` and, when the
    table has a primary key, ``key``; a ``source`` column is kept.  With
    ``track_key_moves`` (the columns labels are identified by) an update that
    changes one of them also deletes what stood under the old values.  The delete
    comes just before its update (``row`` less one), so a label whose own key
    stayed keeps its vertex or edge.
    ``as_text=False`` leaves ``data`` a struct.
    """
    schema = raw.schema["after"].dataType
    db, table = split_origin(F.col("schema_name"))
    offset = F.col("source_offset")
    op, before, after = F.col("op"), F.col("before"), F.col("after")
    picked = F.struct(op.alias("op"), pick_image(op, before, after).alias("image"), F.lit(0).alias("ahead"))
    images = F.array(picked)
    if track_key_moves:
        moved = F.lit(False)
        for name in track_key_moves:
            moved = moved | ~before.getField(name).eqNullSafe(after.getField(name))
        moved = (op == "u") & before.isNotNull() & after.isNotNull() & moved
        images = F.when(
            moved, F.array(F.struct(F.lit("d").alias("op"), before.alias("image"), F.lit(1).alias("ahead")), picked)
        ).otherwise(images)
    envelope = [
        offset["ts_sec"].cast("bigint").alias("ts_sec"),
        db.alias("db"),
        table.alias("table"),
        key_columns(raw).alias("key"),
        parse_time(now).alias("parse_time"),
        seq_of(offset["ts_sec"], offset["pos"], offset["row"], offset["file"]).alias("seq"),
    ]
    if "source" in raw.columns:
        envelope.append(F.col("source"))
    if track_key_moves:
        rows = raw.select(*envelope, F.inline(images))
        # On equal order a delete wins, so it must not share that of its update.
        rows = rows.withColumn("seq", F.col("seq").withField("row", F.col("seq.row") - F.col("ahead"))).drop("ahead")
    else:
        rows = raw.select(*envelope, op, picked["image"].alias("image"))
    data = render_row(F.col("image"), schema, types, **options)
    rows = rows.withColumn("data", F.to_json(data) if as_text else data)
    return rows.select("op", "ts_sec", "db", "table", "data", "key", "parse_time", "seq",
                       *(["source"] if "source" in raw.columns else []))


def normalize_feed(feed: DataFrame, tables: Mapping[str, RawTable], col: str = "value", *,
                   now: int | Column | None = None, **options) -> DataFrame:
    """Raw change JSON of many tables to envelope columns, in one pass.

    ``tables`` describes each captured table by ``db.table``.  A record is parsed
    for its head, and then once more with the schema of its own table.  A record
    of a table that is not described keeps its head and has no ``data``; routing
    rejects it.  Use it as ``decode`` of a stream: ``partial(normalize_feed, tables=...)``.
    """
    text = F.col(quoted(col))
    head = F.from_json(text, f"schema_name string, op string, source_offset {OFFSET_TYPE}")
    kept = [F.col(quoted(c)) for c in feed.columns if c != col]
    # As in decode_envelopes, a generator keeps the parser from being copied.
    rows = feed.select(*kept, text.alias("_text"), F.inline(F.array(head)))
    db, table = split_origin(F.col("schema_name"))
    place = F.concat_ws(".", db, table)
    data, key = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    for name, raw in tables.items():
        image = T.StructType.fromDDL(raw.row)
        both = F.from_json(F.col("_text"), T.StructType([T.StructField("before", image), T.StructField("after", image)]))

        # The array makes the parsed record a value that both images come from.
        once = F.get(F.transform(F.array(both), _renderer(image, raw.types, options)), F.lit(0))
        data = F.when(place == name, once).otherwise(data)
        if raw.key:
            names = F.array(*[F.lit(n) for n in T.StructType.fromDDL(raw.key).names])
            key = F.when(place == name, names).otherwise(key)
    offset = F.col("source_offset")
    return rows.select(
        "op", offset["ts_sec"].alias("ts_sec"), db.alias("db"), table.alias("table"), data.alias("data"), key.alias("key"),
        parse_time(now).alias("parse_time"), seq_of(offset["ts_sec"], offset["pos"], offset["row"], offset["file"]).alias("seq"), *kept)


def _renderer(image: T.StructType, types: Mapping[str, str] | None, options: Mapping) -> Callable[[Column], Column]:
    return lambda record: F.to_json(render_row(pick_image(F.col("op"), record["before"], record["after"]), image, types, **options))


def normalize_geometry(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """Replace a binary geometry column by its text; also return the refused rows.

    The first result has every row, with a null for a geometry of another kind
    or with unreadable bytes.  The second has just those rows, with their bytes
    and ``geometry_kind`` (null: unreadable).
    """
    wkb = F.col(quoted(col))
    if isinstance(df.schema[col].dataType, T.StructType):
        wkb = wkb.getField("wkb")
    text = geometry.wkb_text(wkb)
    kept = df.withColumn(col, text)
    refused = df.where(wkb.isNotNull() & text.isNull()).withColumn("geometry_kind", geometry.wkb_kind(wkb))
    return kept, refused
