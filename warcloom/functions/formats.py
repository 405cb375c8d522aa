"""Human-readable sizes, dates and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def humanbytes(size: Column) -> Column:
    """Decimal units with two decimals; below 1000 the plain float and ``Byte``.

    format_number rounds the binary value half-even, unlike printf-style
    formatting in the JVM, which rounds its decimal rendering half-up.
    """
    value = size.cast("double")

    def two_decimals(v: Column, unit: str) -> Column:
        return F.concat(F.regexp_replace(F.format_number(v, 2), ",", ""), F.lit(f" {unit}"))

    out = F.when(value < 1000, F.concat(value.cast("string"), F.lit(" Byte")))
    for power, unit in ((2, "KB"), (3, "MB"), (4, "GB")):
        out = out.when(value < 1000.0**power, two_decimals(value / F.lit(1000.0 ** (power - 1)), unit))
    return out.otherwise(two_decimals(value / F.lit(1000.0**4), "TB"))


def human_readable_binary(size: Column) -> Column:
    """Binary units, whole-number division shown with one decimal."""
    value = size.cast("bigint")
    out = F.when(value == 1, F.lit("1 byte"))
    for shift, unit in ((50, "PB"), (40, "TB"), (30, "GB"), (20, "MB"), (10, "kB")):
        out = out.when(value >= (1 << shift), F.concat(F.shiftright(value, shift).cast("string"), F.lit(f".0 {unit}")))
    return out.otherwise(F.concat(value.cast("string"), F.lit(".0 bytes")))


def add_months_clamped(date: Column, months: int) -> Column:
    return F.add_months(date, months)


def record_id(timestamp: Column, url: Column) -> Column:
    """``<timestamp>/<base64 of the URL's MD5>``."""
    return F.concat(timestamp, F.lit("/"), F.base64(F.unhex(F.md5(url))))
