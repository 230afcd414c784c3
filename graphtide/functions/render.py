"""Value renderers: source types to the text and numbers an envelope carries.

Everything here is a Column -> Column function made of built-in expressions, so
it stays inside the JVM, and it never looks at the session or JVM time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``use``, however often that mentions it.

    It also keeps plans small: an expression that is substituted for a column
    (a pushed filter, a merged projection) appears once instead of everywhere.
    """
    return F.transform(F.array(value), use)[0]


def floor_div(value: Column, divisor: int) -> Column:
    """Exact floor division of an integer column, also below zero."""
    value = value.cast("bigint")
    d = F.lit(divisor).cast("bigint")
    return F.call_function("div", value - F.pmod(value, d), d)


def signed_bytes(value: Column) -> Column:
    """Binary as text of signed bytes, e.g. ``[1, -1, -128]``."""

    def signed(digits: Column) -> Column:
        # Shift, wrap and shift back: 255 -> -1 with the number mentioned once.
        return ((F.conv(digits, 16, 10).cast("int") + 128) % 256 - 128).cast("string")

    def text(bytes_: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(1), F.length(bytes_)),
            lambda i: signed(F.hex(F.substring(bytes_, i, F.lit(1)))),
        )
        listed = F.concat(F.lit("["), F.array_join(pairs, ", "), F.lit("]"))
        return F.when(F.length(bytes_) == 0, F.lit("[]")).otherwise(listed)

    return let(value, text)


def iso_date(epoch_days: Column) -> Column:
    """Days since 1970-01-01 as ``yyyy-MM-dd``."""
    return F.date_from_unix_date(epoch_days.cast("int")).cast("string")


def iso_local(epoch_seconds: Column, nanos: Column) -> Column:
    """Shortest ISO local date-time.

    Seconds are left out when they and the fraction are zero; a fraction is
    printed with 3, 6 or 9 digits.
    """
    # A timestamp without zone prints the same in every session.
    moment = F.timestamp_add("SECOND", epoch_seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    to_the_minute = F.translate(F.substring_index(moment.cast("string"), ":", 2), " ", "T")
    second = F.pmod(epoch_seconds, F.lit(60).cast("bigint"))
    digits = F.when(nanos % 1_000_000 == 0, 3).when(nanos % 1_000 == 0, 6).otherwise(9)
    fraction = F.concat(F.lit("."), F.substring(_padded(nanos, 9), F.lit(1), digits))
    tail = F.when((second == 0) & (nanos == 0), F.lit("")).otherwise(
        F.concat(F.lit(":"), _padded(second, 2), F.when(nanos == 0, F.lit("")).otherwise(fraction))
    )
    return F.concat(to_the_minute, tail)


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def iso_epoch(value: Column, per_second: int) -> Column:
    """Epoch count with ``per_second`` units per second (10^3, 10^6 or 10^9) as ISO text."""
    value = value.cast("bigint")
    unit = F.lit(per_second).cast("bigint")
    nanos = F.pmod(value, unit) * (1_000_000_000 // per_second)
    return iso_local(floor_div(value, per_second), nanos)


def iso_timestamp_ntz(value: Column) -> Column:
    """A Spark timestamp without zone as ISO text (its own wall clock)."""
    # Taken apart by field: differences between timestamps would pass through the session zone.
    minutes = F.unix_date(value.cast("date")).cast("bigint") * 1440 + F.hour(value) * 60 + F.minute(value)
    micros = (F.extract(F.lit("SECOND"), value) * 1_000_000).cast("bigint")
    return iso_epoch(minutes * 60_000_000 + micros, 1_000_000)


def iso_instant(value: Column, tz: str = "UTC") -> Column:
    """A Spark timestamp (an instant) as the wall clock of zone ``tz``."""
    return iso_epoch(F.unix_micros(F.from_utc_timestamp(value, tz)), 1_000_000)


def iso_zoned(value: Column, tz: str = "UTC", *, malformed: str = "raise") -> Column:
    """ISO instant text (``2022-07-26T04:50:43Z``) as the wall clock of zone ``tz``.

    Text that is no instant fails the job, or becomes null with ``malformed='null'``.
    """
    if malformed not in ("raise", "null"):
        raise ValueError(f"malformed must be 'raise' or 'null', not {malformed!r}")
    # A zone designator is required: a bare local time would be read in the session zone.
    zoned = F.when(value.rlike(r"(Z|[+-]\d{2}(:?\d{2})?)$"), value)
    # An instant stops at microseconds; the digits behind them are taken from the text.
    wall = iso_instant(F.try_to_timestamp(F.regexp_replace(zoned, r"(\.\d{6})\d+", "$1")), tz)
    behind = F.regexp_extract(zoned, r"\.\d{6}(\d{1,3})", 1)
    behind = F.when(behind.rlike("[1-9]"), F.rpad(behind, 3, "0")).otherwise("")

    def with_nanos(wall: Column) -> Column:
        fraction = F.when(wall.contains("."), F.substring_index(wall, ".", -1)).otherwise("")
        seconds = F.when(F.length(wall) == 16, F.concat(wall, F.lit(":00"))).otherwise(F.substring_index(wall, ".", 1))
        return F.when(behind == "", wall).otherwise(F.concat(seconds, F.lit("."), F.rpad(fraction, 6, "0"), behind))

    # The array makes the rendered time a value; named several times it would be computed as often.
    rendered = F.get(F.transform(F.array(wall), with_nanos), F.lit(0))
    if malformed == "null":
        return rendered
    complaint = F.raise_error(F.concat(F.lit("not a zoned timestamp: "), value)).cast("string")
    return F.when(value.isNull(), F.lit(None)).otherwise(F.coalesce(rendered, complaint))


def clock_time(value: Column, per_second: int, pattern: str = "HH:mm:ss") -> Column:
    """Time of day counted in 10^3, 10^6 or 10^9 units per second, to the second.

    ``pattern='hh:mm:ss'`` prints the 12-hour clock (13:12:13 -> 01:12:13).
    """
    seconds = floor_div(value, per_second)
    hour, minute, second = _clock_parts(F.pmod(seconds, F.lit(SECONDS_PER_DAY).cast("bigint")))
    if pattern == "hh:mm:ss":
        hour = F.pmod(hour + 11, F.lit(12).cast("bigint")) + 1
    elif pattern != "HH:mm:ss":
        raise ValueError(f"unknown time pattern {pattern!r}")
    return F.concat(_padded(hour, 2), F.lit(":"), _padded(minute, 2), F.lit(":"), _padded(second, 2))


def _clock_parts(second_of_day: Column) -> tuple[Column, Column, Column]:
    minutes = floor_div(second_of_day, 60)
    return floor_div(minutes, 60), F.pmod(minutes, F.lit(60).cast("bigint")), second_of_day % 60
