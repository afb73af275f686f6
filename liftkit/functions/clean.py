"""Parsing expressions for dirty text columns.

Missing numbers are NULL here, never NaN: a NaN produced by parsing ``'nan'`` is turned into
NULL right after the cast so that aggregates skip it. Casts are ``try_cast`` so bad text gives
NULL instead of an ANSI error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    c = col_of(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def to_number(c) -> Column:
    """Text -> double; unparsable text, NaN and NULL become NULL."""
    return nan_to_null(col_of(c).cast("string").try_cast("double"))


def clean_price(c) -> Column:
    """Money text -> double: drop ``$`` and ``,``; bad values -> NULL."""
    stripped = F.regexp_replace(col_of(c).cast("string"), r"[$,]", "")
    return nan_to_null(stripped.try_cast("double"))


def number_or_zero(c) -> Column:
    """Text -> double with bad or missing values filled by 0."""
    return F.coalesce(to_number(c), F.lit(0.0))


def safe_date(c) -> Column:
    """Text -> date; bad values -> NULL."""
    return col_of(c).cast("string").try_cast("date")


def binarize(c, threshold: float) -> Column:
    """1 when the value is above the threshold, else 0 (missing -> 0)."""
    return F.when(col_of(c) > F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def quoted(name: str) -> str:
    """A column name as an identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"
