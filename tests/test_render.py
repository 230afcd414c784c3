import datetime as dt
import struct
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from graphtide.functions import geometry, render


def values(spark, ddl, items, column):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, v {ddl}").coalesce(1)
    return [r[1] for r in df.select("i", column(F.col("v")).alias("t")).orderBy("i").collect()]


def test_signed_bytes(spark):
    items = [bytearray(b"\x01\xff\x80\x7f\x00"), bytearray(b""), None]
    assert values(spark, "binary", items, render.signed_bytes) == ["[1, -1, -128, 127, 0]", "[]", None]


def test_dates(spark):
    assert values(spark, "int", [11574, 0, -1, -719162, None], render.iso_date) == [
        "2001-09-09", "1970-01-01", "1969-12-31", "0001-01-01", None]


@pytest.mark.parametrize("unit, item, text", [
    (10**3, 1000000020000, "2001-09-09T01:47"),
    (10**3, 1000000000000, "2001-09-09T01:46:40"),
    (10**3, 1000000000120, "2001-09-09T01:46:40.120"),
    (10**6, 1000000020000001, "2001-09-09T01:47:00.000001"),
    (10**6, -1, "1969-12-31T23:59:59.999999"),
    (10**9, 1000000000000000001, "2001-09-09T01:46:40.000000001"),
    (10**9, 1000000000123456000, "2001-09-09T01:46:40.123456"),
    (10**9, -1, "1969-12-31T23:59:59.999999999"),
    (10**9, -(10**18), "1938-04-24T22:13:20"),
])
def test_epoch_text(spark, unit, item, text):
    assert values(spark, "bigint", [item], lambda v: render.iso_epoch(v, unit)) == [text]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture],
          phases=[Phase.explicit, Phase.generate])
@given(st.lists(st.datetimes(dt.datetime(1000, 1, 1), dt.datetime(9999, 1, 1)), min_size=1, max_size=40))
def test_micros_agree_with_python(spark, moments):
    epoch = dt.datetime(1970, 1, 1)
    micros = [(m - epoch) // dt.timedelta(microseconds=1) for m in moments]

    def text(m):
        if m.microsecond:
            return m.isoformat(timespec="milliseconds" if m.microsecond % 1000 == 0 else "microseconds")
        return m.isoformat(timespec="seconds" if m.second else "minutes")

    assert values(spark, "bigint", micros, lambda v: render.iso_epoch(v, 10**6)) == [text(m) for m in moments]


def test_wall_clock_ignores_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist in New York on that day.
        moments = [dt.datetime(2024, 3, 10, 2, 30, 1, 500000), dt.datetime(1883, 11, 18, 12, 1, 0)]
        assert values(spark, "timestamp_ntz", moments, render.iso_timestamp_ntz) == [
            "2024-03-10T02:30:01.500", "1883-11-18T12:01"]
        assert values(spark, "string", ["2024-03-10T07:30:00Z"], render.iso_zoned) == ["2024-03-10T07:30"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_zoned(spark):
    items = ["2031-03-05T06:07:08Z", "2031-03-05T06:07:08.120+02:00", None, "2031-03-05T06:07:08.123456789Z", "2031-03-05T06:07:00.000000001Z", "2031-03-05T06:07:08.120000000Z"]
    assert values(spark, "string", items, lambda v: render.iso_zoned(v, "Asia/Shanghai")) == [
        "2031-03-05T14:07:08", "2031-03-05T12:07:08.120", None, "2031-03-05T14:07:08.123456789", "2031-03-05T14:07:00.000000001", "2031-03-05T14:07:08.120"]
    bad = ["2031-03-05T06:07:08", "soon"]
    assert values(spark, "string", bad, lambda v: render.iso_zoned(v, malformed="null")) == [None, None]
    with pytest.raises(PySparkException, match="not a zoned timestamp: soon"):
        values(spark, "string", ["soon"], render.iso_zoned)


@pytest.mark.parametrize("unit, item, day, half", [
    (10**6, 29106000000, "08:05:06", "08:05:06"),
    (10**6, 47533999999, "13:12:13", "01:12:13"),
    (10**9, 47533 * 10**9, "13:12:13", "01:12:13"),
    (10**3, 47533000, "13:12:13", "01:12:13"),
    (10**3, 0, "00:00:00", "12:00:00"),
    (10**3, -1000, "23:59:59", "11:59:59"),
])
def test_time_of_day(spark, unit, item, day, half):
    assert values(spark, "bigint", [item], lambda v: render.clock_time(v, unit)) == [day]
    assert values(spark, "bigint", [item], lambda v: render.clock_time(v, unit, "hh:mm:ss")) == [half]


# -- geometry ------------------------------------------------------------------

SQUARE = [(0, 0), (1, 0), (1, 1.5), (0, 0)]


def wkb(kind, body, order="<", flags=0):
    return bytearray(struct.pack(order + "BI", order == "<", kind | flags) + body)


def coords(points, order="<"):
    return b"".join(struct.pack(f"{order}{len(p)}d", *p) for p in points)


def counted(points, order="<"):
    return struct.pack(order + "I", len(points)) + coords(points, order)


def polygon(rings, order="<"):
    return wkb(3, struct.pack(order + "I", len(rings)) + b"".join(counted(r, order) for r in rings), order)


@pytest.mark.parametrize("value, kind, text", [
    (wkb(1, coords([(13.5, 52.25)])), "Point", "POINT (13.5 52.25)"),
    (wkb(1, coords([(-1, 1e-7)], ">"), ">"), "Point", "POINT (-1 0.0000001)"),
    (wkb(1, coords([(1e22, 123456789.125)])), "Point", "POINT (10000000000000000000000 123456789.125)"),
    (wkb(1, coords([(float("nan"),) * 2])), "Point", "POINT EMPTY"),
    (wkb(1, struct.pack("<I", 4326) + coords([(1, 2, 3)]), flags=0xA0000000), "Point", "POINT (1 2)"),
    (wkb(1001, coords([(1, 2, 3)])), "Point", "POINT (1 2)"),
    (wkb(3002, counted([(1, 2, 3, 4), (5, 6, 7, 8)])), "LineString", "LINESTRING (1 2, 5 6)"),
    (wkb(2, counted([(1, 2), (3.25, -4)])), "LineString", "LINESTRING (1 2, 3.25 -4)"),
    (wkb(2, counted([])), "LineString", "LINESTRING EMPTY"),
    (wkb(2, counted([(1, 2)])), "LineString", None),
    (wkb(2, counted([(1, 2), (3, 4)])[:-3]), "LineString", None),
    (polygon([SQUARE, SQUARE[::-1]]), "Polygon", "POLYGON ((0 0, 1 0, 1 1.5, 0 0), (0 0, 1 1.5, 1 0, 0 0))"),
    (polygon([SQUARE], ">"), "Polygon", "POLYGON ((0 0, 1 0, 1 1.5, 0 0))"),
    (polygon([SQUARE[:3] + [(9, 9)]]), "Polygon", None),
    (polygon([SQUARE])[:-1], "Polygon", None),
    (polygon([]), "Polygon", "POLYGON EMPTY"),
    (wkb(2, struct.pack("<I", 2**32 - 1)), "LineString", None),
    (wkb(3, struct.pack("<I", 2**32 - 1)), "Polygon", None),
    (wkb(4, struct.pack("<I", 0)), "MultiPoint", None),
    (wkb(7, struct.pack("<I", 0)), "GeometryCollection", None),
    (wkb(99, b""), None, None),
    (bytearray(b"\x07\x01"), None, None),
    (bytearray(b""), None, None),
    (None, None, None),
])
def test_geometry(spark, value, kind, text):
    df = spark.createDataFrame([(value,)], "b binary")
    got = df.select(geometry.wkb_kind(F.col("b")), geometry.wkb_text(F.col("b"))).first()
    assert tuple(got) == (kind, text)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture],
          phases=[Phase.explicit, Phase.generate])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=2, max_size=30), st.sampled_from("<>"))
def test_every_double_is_read_exactly(spark, numbers, order):
    points = list(zip(numbers, numbers[::-1]))
    df = spark.createDataFrame([(wkb(2, counted(points, order), order),)], "b binary")
    text = df.select(geometry.wkb_text(F.col("b"))).first()[0]
    read = [tuple(float(o) for o in p.split(" ")) for p in text.removeprefix("LINESTRING (")[:-1].split(", ")]
    assert read == points
    assert "e" not in text.lower().removeprefix("linestring")


def test_decimal_and_boolean_survive(spark):
    df = spark.createDataFrame([(Decimal("1.20"), True)], "d decimal(5,2), b boolean")
    assert df.select(F.to_json(F.struct("*"))).first()[0] == '{"d":1.20,"b":true}'
