"""Text to typed values that turn bad input into NULL (ANSI mode raises instead)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_int(c, type_name: str = "int") -> Column:
    """'12' and '12.0' -> 12, 'x' / overflow -> NULL.  What is no whole number as it stands goes
    through a wide decimal (not double), so a 19-digit key stays exact."""
    return F.coalesce(_c(c).try_cast(type_name), _c(c).try_cast("decimal(38,18)").try_cast(type_name))


def try_double(c) -> Column:
    return _c(c).try_cast("double")


def lenient_int(c, type_name: str = "int") -> Column:
    """'2.5' -> 2, '0.5' -> 0, 'x' / overflow -> NULL.

    Goes through double first: a plain ``try_cast('2.5' as int)`` is NULL,
    while the legacy implicit cast the jobs were written against truncates.
    """
    return _c(c).try_cast("double").try_cast(type_name)


def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(_c(c), fmt)
