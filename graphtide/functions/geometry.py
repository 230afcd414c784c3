"""Well-known-binary geometry columns to text, with built-in expressions only.

Kinds kept are point, line string and polygon; the spatial reference id is
ignored and only the first two ordinates are printed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphtide.functions.render import let

# Geometry codes of the well-known-binary format.
POINT, LINESTRING, POLYGON = 1, 2, 3
KIND_NAMES = {
    1: "Point",
    2: "LineString",
    3: "Polygon",
    4: "MultiPoint",
    5: "MultiLineString",
    6: "MultiPolygon",
    7: "GeometryCollection",
}
# Flag bits of the extended format.
Z_FLAG, M_FLAG, SRID_FLAG = 0x80000000, 0x40000000, 0x20000000

# Plain decimal text of a double: at least one integer digit, all fraction digits.
PLAIN_DECIMAL = "0." + "#" * 340


def _hex_at(wkb: Column, start: Column, size: int) -> Column:
    """Big-endian hex of ``size`` bytes at 1-based ``start``, whatever the byte order."""

    def ordered(raw: Column) -> Column:
        pairs = [F.substring(raw, 2 * i + 1, 2) for i in reversed(range(size))]
        return F.when(_little_endian(wkb), F.concat(*pairs)).otherwise(raw)

    return let(F.hex(F.substring(wkb, start, F.lit(size))), ordered)


def _little_endian(wkb: Column) -> Column:
    return F.substring(wkb, 1, 1) == F.lit(b"\x01")


def _uint_at(wkb: Column, start: Column) -> Column:
    return F.conv(_hex_at(wkb, start, 4), 16, 10).cast("bigint")


def _double_at(wkb: Column, start: Column) -> Column:
    """IEEE-754 double from its 64 bits: (-1)^s * m * 2^e, exact because m and 2^e are."""

    def value(bits: Column) -> Column:
        exponent = F.shiftrightunsigned(bits, 52).bitwiseAND(F.lit(0x7FF))
        fraction = bits.bitwiseAND(F.lit((1 << 52) - 1))
        implicit = fraction.bitwiseOR(F.lit(1 << 52))
        normal = implicit.cast("double") * F.pow(F.lit(2.0), (exponent - 1075).cast("double"))
        tiny = fraction.cast("double") * F.pow(F.lit(2.0), F.lit(-1074.0))
        magnitude = (
            F.when(exponent == 0x7FF, F.lit(float("nan"))).when(exponent == 0, tiny).otherwise(normal)
        )
        return F.when(bits < 0, -magnitude).otherwise(magnitude)

    return let(F.conv(_hex_at(wkb, start, 8), 16, -10).cast("bigint"), value)


def _type_word(wkb: Column) -> Column:
    return _uint_at(wkb, F.lit(2))


def _flag(word: Column, bit: int) -> Column:
    return word.bitwiseAND(F.lit(bit)) != 0


def _code(word: Column) -> Column:
    """Kind plus 1000 x dimension class, flag bits removed."""
    return word.bitwiseAND(F.lit(0xFFFF))


def wkb_kind(wkb: Column) -> Column:
    """Kind name of a geometry (``Point``, ``MultiPolygon``, ...), null when unreadable."""
    return let(wkb, _kind)


def _kind(wkb: Column) -> Column:
    kinds = F.create_map(*[F.lit(x) for pair in KIND_NAMES.items() for x in pair])
    return F.when(_readable(wkb), F.try_element_at(kinds, (_code(_type_word(wkb)) % 1000).cast("int")))


def _readable(wkb: Column) -> Column:
    return (F.length(wkb) >= 5) & F.substring(wkb, 1, 1).isin(b"\x00", b"\x01")


def _plain(ordinate: Column) -> Column:
    """Shortest decimal text without an exponent; whole numbers carry no fraction."""

    def text(s: Column) -> Column:
        spelled_out = F.call_function("format_number", s.cast("double"), F.lit(PLAIN_DECIMAL))
        return F.when(F.contains(s, F.lit("E")), spelled_out).otherwise(
            F.when(F.endswith(s, F.lit(".0")), F.substring(s, F.lit(1), F.length(s) - 2)).otherwise(s)
        )

    return let(ordinate.cast("string"), text)


def _pair(wkb: Column, start: Column) -> Column:
    return F.concat_ws(" ", _plain(_double_at(wkb, start)), _plain(_double_at(wkb, start + 8)))


def _indices(count: Column) -> Column:
    """0 .. count-1, empty for zero."""
    return F.when(count > 0, F.sequence(F.lit(0).cast("bigint"), count - 1)).otherwise(
        F.array().cast("array<bigint>")
    )


def _pairs(wkb: Column, first: Column, count: Column, stride: Column) -> Column:
    return F.transform(_indices(count), lambda i: _pair(wkb, (first + i * stride).cast("int")))


def _header(wkb: Column) -> Column:
    """(kind, 1-based offset of the body, bytes per coordinate)."""

    def header(word: Column) -> Column:
        dims = F.floor(_code(word) / 1000)
        has_z = (_flag(word, Z_FLAG) | dims.isin(1, 3)).cast("bigint")
        has_m = (_flag(word, M_FLAG) | dims.isin(2, 3)).cast("bigint")
        return F.struct(
            (_code(word) % 1000).alias("kind"),
            (F.lit(6).cast("bigint") + _flag(word, SRID_FLAG).cast("bigint") * 4).alias("body"),
            (F.lit(16).cast("bigint") + (has_z + has_m) * 8).alias("stride"),
        )

    return F.when(_readable(wkb), let(_type_word(wkb), header))


def _run(at: Column, count: Column) -> Column:
    return F.struct(at.cast("bigint").alias("at"), count.cast("bigint").alias("count"))


def _fits(wkb: Column, run: Column, stride: Column) -> Column:
    """Does a run of coordinates lie inside the value?"""
    return run.getField("at") + run.getField("count") * stride - 1 <= F.length(wkb)


def _counted_run(wkb: Column, at: Column) -> Column:
    """Run of coordinates whose number stands before it, null when cut short."""
    return F.when(at + 3 <= F.length(wkb), _run(at + 4, _uint_at(wkb, at.cast("int"))))


def _rings(wkb: Column, body: Column, stride: Column) -> Column:
    """Runs of a polygon, walked once: each ring starts where the one before ended.

    Null when a ring is cut short.
    """
    start = F.struct(
        (body + 4).alias("at"), F.array().cast("array<struct<at: bigint, count: bigint>>").alias("runs"),
        F.lit(True).alias("ok"),
    )

    def step(acc: Column, _: Column) -> Column:
        def onward(run: Column) -> Column:
            inside = F.coalesce(acc.getField("ok") & _fits(wkb, run, stride), F.lit(False))
            end = run.getField("at") + run.getField("count") * stride
            return F.struct(
                F.when(inside, end).otherwise(acc.getField("at")).alias("at"),
                F.when(inside, F.array_append(acc.getField("runs"), run))
                .otherwise(acc.getField("runs")).alias("runs"),
                inside.alias("ok"),
            )

        return let(_counted_run(wkb, acc.getField("at")), onward)

    def walk(outer: Column) -> Column:
        # A ring takes at least four bytes, so a longer list cannot be inside the value.
        number = outer.getField("count")
        walked = F.aggregate(_indices(number), start, step)
        return F.when(
            number * 4 <= F.length(wkb),
            let(walked, lambda w: F.when(w.getField("ok"), w.getField("runs"))),
        )

    return let(_counted_run(wkb, body), walk)


def _coordinates(points: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(points, ", "), F.lit(")"))


def _closed(points: Column) -> Column:
    """Is a ring empty, or does it end where it began?"""
    ends_meet = F.try_element_at(points, F.lit(1)) == F.try_element_at(points, F.lit(-1))
    return (F.size(points) == 0) | ((F.size(points) >= 4) & ends_meet)


def _shape(kind: Column, parts: Column) -> Column:
    """Text of a geometry from the coordinate texts of its runs; null when they make none."""
    first = parts[0]
    size = F.size(first)
    # A point without position is stored with ordinates that are not numbers.
    point = F.when(F.startswith(first[0], F.lit("NaN")), F.lit("POINT EMPTY")).otherwise(
        F.concat(F.lit("POINT "), _coordinates(first))
    )
    line = F.when(size == 0, F.lit("LINESTRING EMPTY")).when(
        size >= 2, F.concat(F.lit("LINESTRING "), _coordinates(first))
    )
    rings = F.transform(parts, lambda r: F.when(F.size(r) == 0, F.lit("EMPTY")).otherwise(_coordinates(r)))
    polygon = F.when(F.size(parts) == 0, F.lit("POLYGON EMPTY")).when(
        F.forall(parts, _closed), F.concat(F.lit("POLYGON "), _coordinates(rings))
    )
    return F.when(kind == POINT, point).when(kind == LINESTRING, line).when(kind == POLYGON, polygon)


def wkb_text(wkb: Column) -> Column:
    """Well-known text of a point, line string or polygon.

    Null for every other kind and for bytes that hold no valid geometry of
    these kinds (truncated, open ring, one-point line).
    """

    def with_header(b: Column, h: Column) -> Column:
        kind, body, stride = h.getField("kind"), h.getField("body"), h.getField("stride")
        runs = (
            F.when(kind == POINT, F.array(_run(body, F.lit(1))))
            .when(kind == LINESTRING, F.array(_counted_run(b, body)))
            .when(kind == POLYGON, _rings(b, body, stride))
        )

        def print_runs(found: Column) -> Column:
            inside = F.forall(found, lambda r: F.coalesce(_fits(b, r, stride), F.lit(False)))
            printed = F.transform(found, lambda r: _pairs(b, r.getField("at"), r.getField("count"), stride))
            return F.when(inside, let(printed, lambda p: _shape(kind, p)))

        return let(runs, print_runs)

    return let(wkb, lambda b: let(_header(b), lambda h: with_header(b, h)))
