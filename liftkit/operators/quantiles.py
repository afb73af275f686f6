"""Exact quantiles with linear interpolation, distributed.

Spark's ``percentile`` / ``median`` aggregates keep a value -> count map per group and merge
it in one task, so one hot group (or one column with hundreds of millions of distinct values)
lands in a single task. Here the same answer is computed with shuffles only:

1. ``groupBy(keys, value).count()``: one row per distinct value (partial aggregation first);
2. those rows fall into buckets that are a pure function of the value and hold at most
   ``bound`` rows of a group (``ranking.bucketed``); bucket totals give each bucket's offset
   within its group;
3. each group's quantile sits at 0-based position h = (n - 1) q; the one or two buckets whose
   range holds floor(h) and ceil(h) are ranked inside, and their rows at those positions give
   the two order statistics, interpolated linearly (the definition pandas, DuckDB
   ``quantile_cont`` and Spark ``percentile`` share).

Missing values are ignored, as in those aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftkit.operators import ranking


def grouped_quantile(df: DataFrame, keys: list[str], value: str, q: float, name: str = "quantile",
                     weight: str | None = None, bound: int = ranking.TASK_ROWS) -> DataFrame:
    """Exact ``q`` quantile of ``value`` per group of ``keys`` (all rows when ``keys`` is empty).

    Rows with a missing key are dropped (as a grouped aggregate over present keys). With
    ``weight``, each row stands for that many rows (a pre-aggregated input)."""
    keys = list(keys)
    present = [F.col(c).isNotNull() for c in [*keys, value]]
    data = df.select(*keys, value, *([weight] if weight else []))
    for p in present:
        data = data.filter(p)
    cnt = F.sum(weight) if weight else F.count(F.lit(1))
    per = data.groupBy(*keys, value).agg(cnt.cast("long").alias("_cnt"))
    per = ranking.bucketed(per, value, keys, bound=bound)
    h = (F.col("_n") - 1) * F.lit(float(q))
    lo, hi = F.floor(h), F.ceil(h)
    offsets = ranking.bucket_offsets(per, keys, F.col("_cnt"))
    end = F.col("_off") + F.col("_tot")
    holding = offsets.filter(((F.col("_off") <= lo) & (lo < end)) | ((F.col("_off") <= hi) & (hi < end)))
    runs = ranking.attach_offsets(per, holding, keys, "inner")
    local = Window.partitionBy("_bucket", *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = runs.withColumn("_end", F.col("_off") + F.sum("_cnt").over(local)).withColumn("_start", F.col("_end") - F.col("_cnt"))
    covers_lo = (F.col("_start") <= lo) & (lo < F.col("_end"))
    covers_hi = (F.col("_start") <= hi) & (hi < F.col("_end"))
    picked = runs.filter(covers_lo | covers_hi).groupBy(*keys).agg(
        F.max(F.when(covers_lo, F.col(value))).alias("_v_lo"),
        F.max(F.when(covers_hi, F.col(value))).alias("_v_hi"),
        F.max(h - F.floor(h)).alias("_frac"),
    )
    out = picked.select(*keys, (F.col("_v_lo") + F.col("_frac") * (F.col("_v_hi") - F.col("_v_lo"))).alias(name))
    return out if keys else out.filter(F.col(name).isNotNull())


def quantile(df: DataFrame, value: str, q: float, name: str = "quantile") -> DataFrame:
    """Exact ``q`` quantile over all rows, as a one-row frame (no row when all are missing)."""
    return grouped_quantile(df, [], value, q, name)
