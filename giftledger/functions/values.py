"""Parsing of dates and amounts as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import AMOUNT
from .text import _col


YEAR = "(?!0000)[0-9]{4}"


def parse_contribution_date(column: Column | str, lenient: bool = False) -> Column:
    """MMDDYYYY text to a date; anything else gives null.

    ``lenient`` also takes a month or day written with one digit, reading as many digits as possible from the
    left (``1012025`` is 2025-10-01).
    """
    text = _col(column)
    if not lenient:
        return F.when(text.rlike(rf"^[0-9]{{4}}{YEAR}\z"), F.try_to_date(text, "MMddyyyy"))
    shape = rf"^(1[0-2]|0[1-9]|[1-9])(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])({YEAR})\z"
    month, day, year = (F.regexp_extract(text, shape, group) for group in (1, 2, 3))
    padded = F.concat(F.lpad(month, 2, "0"), F.lpad(F.trim(day), 2, "0"), year)
    return F.when(text.rlike(shape), F.try_to_date(padded, "MMddyyyy"))


def parse_iso_date(column: Column | str) -> Column:
    """YYYY-MM-DD text to a date, null on failure."""
    return F.try_to_date(_col(column), "yyyy-MM-dd")


def parse_amount(column: Column | str, dtype: T.DecimalType = AMOUNT) -> Column:
    """Text or number to an exact decimal, null on failure."""
    return _col(column).try_cast(dtype)


def strict_cast(column: Column | str, dtype: T.DataType) -> Column:
    """Cast that stops the job on a value that does not fit, whatever the session's ANSI setting is."""
    value = _col(column)
    cast = value.try_cast(dtype)
    message = F.concat(F.lit(f"value is not a {dtype.simpleString()}: "), value.cast("string"))
    return F.when(value.isNotNull() & cast.isNull(), F.raise_error(message).cast(dtype)).otherwise(cast)


def percent(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """100 * part / whole, rounded; 0 for an empty whole."""
    part, whole = _col(part), _col(whole)
    ratio = part.cast("double") * 100 / F.when(whole != 0, whole.cast("double"))
    return F.round(F.coalesce(ratio, F.lit(0.0)), digits)
