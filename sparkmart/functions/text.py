"""String column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# fixed values: ten digits are shown as (XXX) XXX-XXXX
PHONE_DIGITS = 10
PHONE_PATTERN, PHONE_FORMAT = r"(?U)^(\d{3})(\d{3})(\d{4})$", "($1) $2-$3"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_phone(c) -> Column:
    """Keep digits only; exactly ten digits become ``(XXX) XXX-XXXX``.

    Any other length keeps the original text (not the stripped digits).
    NULL stays NULL.  ``(?U)`` makes ``\\d`` Unicode-aware, as Python's is.
    """
    digits = F.regexp_replace(_c(c), r"(?U)\D", "")
    pretty = F.regexp_replace(digits, PHONE_PATTERN, PHONE_FORMAT)
    return F.when(F.length(digits) == PHONE_DIGITS, pretty).otherwise(_c(c))


def title_case(c) -> Column:
    """First letter of each space-separated word upper, the rest lower."""
    return F.initcap(_c(c))


def full_name(first, last) -> Column:
    """``upper(first || ' ' || last)``; a NULL part gives NULL (``concat``)."""
    return F.upper(F.concat(_c(first), F.lit(" "), _c(last)))
