"""Missing values and keys. NULL is the only missing value inside the engine: NaN and infinities become NULL at the edge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Published estimates use large negative codes for "not available".
SENTINEL_FLOOR = -100_000_000.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """The value, or NULL where it is NaN or infinite."""
    c = _col(c).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def number(c: Column | str) -> Column:
    """Text or number as a finite double; what is no number is NULL."""
    return finite(_col(c).try_cast("double"))


def estimate(c: Column | str) -> Column:
    """A number whose "not available" codes are NULL."""
    c = number(c)
    return F.when(c > SENTINEL_FLOOR, c)


def strict_year(c: Column | str) -> Column:
    """A year; text that is no number is an error, as a silent NULL would lose rows."""
    return _col(c).cast("double").cast("int")


def area_id(c: Column | str, width: int = 11) -> Column:
    """An area code without blanks or a trailing ``.0``, padded with zeros (never cut) to ``width``."""
    plain = F.regexp_replace(F.trim(_col(c).cast("string")), r"\.0$", "")
    return F.when(F.length(plain) < width, F.lpad(plain, width, "0")).otherwise(plain)


def tract(c: Column | str) -> Column:
    return F.substring(_col(c), 1, 11)


def county(c: Column | str) -> Column:
    return F.substring(_col(c), 1, 5)


def state(c: Column | str) -> Column:
    return F.substring(_col(c), 1, 2)


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b for positive b, else NULL."""
    a, b = _col(a), _col(b)
    return F.when(b > 0, a / b)


#: Square metres in a square mile.
SQUARE_MILE = 2_589_988.110336


def square_miles(square_metres: Column | str) -> Column:
    return _col(square_metres) / SQUARE_MILE
