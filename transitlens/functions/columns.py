"""Column functions.  All are built-in Spark expressions (no Python UDF), so
they stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def heading_within(bearing, center: float = 0.0, tolerance: float = 45.0) -> Column:
    """True when ``bearing`` (degrees, 0..360) lies within ``center ± tolerance``,
    bounds inclusive.  With the defaults: [315, 360] or [0, 45]; negative
    bearings and bearings above 360 never match."""
    b = _c(bearing)
    lo, hi = center - tolerance, center + tolerance
    if lo < 0:
        return b.between(lo + 360.0, 360.0) | b.between(0.0, hi)
    if hi > 360:
        return b.between(lo, 360.0) | b.between(0.0, hi - 360.0)
    return b.between(lo, hi)


def number_text(x) -> Column:
    """Text of a number the way a JSON number would be printed: integral
    values without a fraction (``45``), others with one (``45.5``); from 1e16
    up and below 1e-4 with an exponent (``1e+20``, ``5e-05``)."""
    v = _c(x)
    # Java writes d.dddE[-]x beyond [1e-3, 1e7); decimals bring it to digits
    java = v.cast("double").cast("string")
    mantissa = F.regexp_replace(F.regexp_extract(java, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    power = F.regexp_extract(java, r"E(-?[0-9]+)$", 1).cast("int")
    exponent = F.concat(mantissa, F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    plain = F.regexp_replace(v.cast("double").cast("decimal(38,20)").cast("string"), r"0+$", "")
    return (
        F.when(v.isNull(), F.lit("null"))
        .when((v == F.floor(v)) & (F.abs(v) < 1e16), F.floor(v).cast("string"))
        .when((F.abs(v) >= 1e16) | (F.abs(v) < 1e-4), exponent)
        .when(java.contains("E"), plain)
        .otherwise(java)
    )


def _ascii_only(text: Column) -> Column:
    """Replace every non-ASCII UTF-16 code unit by ``\\uXXXX`` (lowercase hex;
    characters beyond the BMP become surrogate pairs)."""
    units = F.regexp_extract_all(F.hex(F.encode(text, "UTF-16BE")), F.lit("(.{4})"), 1)
    return F.array_join(
        F.transform(
            units,
            lambda u: F.when(F.conv(u, 16, 10).cast("int") < 127, F.char(F.conv(u, 16, 10).cast("int"))).otherwise(
                F.concat(F.lit("\\u"), F.lower(u))
            ),
        ),
        "",
    )


def json_string(s) -> Column:
    """A string as a quoted JSON literal, escaped like a JSON dump with ASCII
    output: quotes, backslashes and control characters by ``to_json``, DEL and any
    non-ASCII character as ``\\uXXXX`` (only lines that hold one pay for it)."""
    array = F.to_json(F.array(_c(s)))
    quoted = F.substring(array, F.lit(2), F.length(array) - 2)  # without the brackets
    return F.when(quoted.rlike("[^\\x00-\\x7E]"), _ascii_only(quoted)).otherwise(quoted)


def json_pair_line(key, number) -> Column:
    """``["<key>", <number>]`` with the ``", "`` separator of a JSON dump."""
    return F.concat(F.lit("["), json_string(key), F.lit(", "), number_text(number), F.lit("]"))


def iso_text(epoch_ms) -> Column:
    """ISO-8601 text of epoch milliseconds in UTC, ``YYYY-MM-DDTHH:MM:SS`` with a
    six-digit fraction only when the fraction is not zero."""
    ms = _c(epoch_ms)
    wall = F.timestamp_add("MILLISECOND", ms, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    frac = F.pmod(ms, F.lit(1000))
    return F.concat(
        F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(frac != 0, F.format_string(".%03d000", frac)).otherwise(F.lit("")),
    )


def duration_text(micros) -> Column:
    """Text of a non-negative duration given in microseconds, in the form
    ``H:MM:SS``, ``H:MM:SS.ffffff`` and ``D day(s), ...`` for a day or more."""
    us = _c(micros)
    day_us = 86400 * 1000000
    days = F.floor(us / day_us).cast("bigint")
    rest = us - days * day_us
    secs = F.floor(rest / 1000000).cast("bigint")
    frac = (rest - secs * 1000000).cast("bigint")
    clock = F.format_string(
        "%d:%02d:%02d", F.floor(secs / 3600).cast("bigint"), F.floor((secs % 3600) / 60).cast("bigint"), secs % 60
    )
    clock = F.concat(clock, F.when(frac != 0, F.format_string(".%06d", frac)).otherwise(F.lit("")))
    prefix = (
        F.when(days == 0, F.lit(""))
        .when(days == 1, F.lit("1 day, "))
        .otherwise(F.format_string("%d days, ", days))
    )
    return F.concat(prefix, clock)


def adjacent_deltas(values) -> Column:
    """Differences of neighbouring elements of an array: ``[b-a, c-b, ...]``;
    empty for fewer than two elements."""
    a = _c(values)
    return F.when(
        F.size(a) > 1,
        F.transform(F.sequence(F.lit(2), F.size(a)), lambda i: F.element_at(a, i) - F.element_at(a, i - 1)),
    ).otherwise(F.array().cast("array<bigint>"))
