"""Numbers: lenient decimal parsing, safe ratios, printed forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_decimal(text: str | Column) -> Column:
    """``1234,56`` to DECIMAL(15,2); NULL when the text is not a number."""
    return F.replace(_col(text), F.lit(","), F.lit(".")).try_cast("decimal(15,2)")


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Double division; NULL instead of an error when the denominator is zero."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def percent(part: str | Column, whole: str | Column) -> Column:
    return F.try_divide(F.lit(100.0) * _col(part).cast("double"), _col(whole).cast("double"))


def per_100k(count: str | Column, inhabitants: str | Column) -> Column:
    return F.try_divide(
        _col(count).cast("double") * F.lit(100000.0), _col(inhabitants).cast("double")
    )


def growth_percent(now: str | Column, before: str | Column) -> Column:
    now, before = _col(now).cast("double"), _col(before).cast("double")
    return F.try_divide(F.lit(100.0) * (now - before), before)


def thousands(value: str | Column) -> Column:
    """``1.234.567``: rounded half to even, dots between the thousands."""
    return F.translate(F.format_number(_col(value), 0), ",", ".")


def decimal_comma(value: str | Column, places: int = 1) -> Column:
    """``1234,5``: a decimal comma and no mark between the thousands."""
    plain = F.replace(F.format_number(_col(value), places), F.lit(","), F.lit(""))
    return F.translate(plain, ".", ",")


def thousands_free(value: str | Column) -> Column:
    """A rounded number without any marks: ``1234``."""
    return F.replace(F.format_number(_col(value), 0), F.lit(","), F.lit(""))
