"""Listing cleaning: parse dirty text columns, drop price outliers, drop zero prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftkit.functions import clean as C
from liftkit.operators import quantiles


def clean_listings(raw: DataFrame) -> DataFrame:
    """Parse price (money text), last review (date), and fill reviews-per-month and
    availability with 0 when missing or unparsable."""
    out = raw.withColumns(
        {
            "price": C.clean_price("price"),
            "reviews_per_month": C.number_or_zero("reviews_per_month"),
            "availability_365": C.number_or_zero("availability_365"),
        }
    )
    if "last_review" in raw.columns:
        out = out.withColumn("last_review", C.safe_date("last_review"))
    return out


def price_bound(df: DataFrame, q: float = 0.99, col: str = "price", method: str = "distributed",
                accuracy: int = 100000) -> DataFrame:
    """One-row frame with the ``q`` quantile of ``col`` over every parsed value.

    ``distributed`` (default) is exact and never merges a value map in one task (see
    ``quantiles``); ``aggregate`` is Spark's exact ``percentile`` (fine up to a few million
    distinct values); ``approx`` is ``percentile_approx``. The exact forms interpolate
    linearly, as pandas and DuckDB ``quantile_cont`` do.
    """
    if method == "distributed":
        return quantiles.quantile(df, col, q, "_upper_bound")
    agg = F.percentile(col, q) if method == "aggregate" else F.percentile_approx(col, q, accuracy)
    return df.agg(agg.alias("_upper_bound"))


def outlier_filter(df: DataFrame, q: float = 0.99, col: str = "price", method: str = "distributed") -> DataFrame:
    """Keep rows with 0 < value < the ``q`` quantile of all parsed values (both bounds strict).

    The bound is a scalar subquery: Spark runs the one-row result once and inlines the value
    into the filter, so the table is neither joined nor shuffled for it.
    """
    bound = price_bound(df, q, col, method).select("_upper_bound").scalar()
    return df.filter((F.col(col) > 0) & (F.col(col) < bound))


def drop_zero(df: DataFrame, col: str = "price") -> DataFrame:
    """Drop rows whose value is exactly 0; a missing value stays."""
    return df.filter(~F.col(col).eqNullSafe(F.lit(0)))


def binarize(df: DataFrame, col: str, threshold: float, out: str | None = None) -> DataFrame:
    """Replace (or add) a 0/1 column: value > threshold -> 1, else 0 (missing -> 0)."""
    return df.withColumn(out or col, C.binarize(col, threshold))
