"""Scalar helpers over built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from obsflow.fixed_values import (
    ACCEPTED_STATUS,
    COORDINATE_SCALE,
    STAMP_MICROS,
    STAMP_SECONDS,
    TOTAL_MESSAGE,
)
from obsflow.schemas import COORDINATE, MEASURE


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def to_epoch(moment: Column) -> Column:
    """Whole seconds since 1970, fractions cut off."""
    return F.unix_timestamp(moment.cast("timestamp"))


def as_coordinate(value: Column) -> Column:
    return value.try_cast(COORDINATE)


def as_measure(value: Column) -> Column:
    return value.try_cast(MEASURE)


def as_date(value: Column) -> Column:
    return value.try_cast("date")


def as_long(value: Column) -> Column:
    return value.try_cast("bigint")


def rounded(value: Column, scale: int = COORDINATE_SCALE) -> Column:
    """A coordinate as a join key: exact decimal, rounded once, half away from zero."""
    return F.round(value.try_cast("decimal(38,18)"), scale)


def exact_average(total: str, count: str) -> str:
    """SQL for ``total / count`` as decimal(18,2), rounded once, half away from zero.

    Decimal division rounds at its own scale first, which can tip a mean just below a half. Whole
    numbers don't: with values of six places, (2 * sum + n) // (2 * n) at the scale wanted is exact.
    """
    micros = f"CAST(abs({total}) * 1000000 AS DECIMAL(38,0))"
    rows = f"CAST({count} AS DECIMAL(19,0))"
    cents = f"((2 * {micros} + 10000 * {rows}) DIV (20000 * {rows}))"
    sign = f"CASE WHEN {total} < 0 THEN -1 ELSE 1 END"
    return f"CASE WHEN {count} > 0 THEN CAST({sign} * CAST({cents} AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2)) END"


def is_blank(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit("")).isNull()


def is_accepted(status: Column) -> Column:
    return F.coalesce(status.isin(*ACCEPTED_STATUS), F.lit(False))


def first_field(entries: Column, field: str) -> Column:
    """One field of the first struct of an array; null when there is none."""
    return F.try_element_at(entries.getField(field), F.lit(1))


def optional(lookup: Column, key: str) -> Column:
    """A map value, null when the key is missing."""
    return F.try_element_at(lookup, F.lit(key))


def stamp(moment: Column, micros: bool = False) -> Column:
    """The digits of a moment, as used in names of landed files."""
    return F.date_format(moment, STAMP_MICROS if micros else STAMP_SECONDS)


def point_text(latitude: Column, longitude: Column) -> Column:
    return F.concat_ws(",", latitude, longitude)


def request_address(host: Column, endpoint: Column) -> Column:
    return F.concat(host, endpoint)


def total_message(total: Column) -> Column:
    return F.format_string(TOTAL_MESSAGE, total)


def escape_breaks(text: Column) -> Column:
    """Line breaks and backslashes as two characters each, for formats with one row to a line."""
    for plain, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def restore_breaks(text: Column) -> Column:
    """Undoes ``escape_breaks``: pairs of backslashes first part the text, so none is taken for an escape."""
    parts = F.split(text, r"\\\\", -1)
    restored = F.transform(
        parts,
        lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")),
    )
    return F.when(text.contains("\\"), F.array_join(restored, "\\")).otherwise(text)
