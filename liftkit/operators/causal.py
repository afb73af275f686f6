"""Difference-in-differences, pre-trend check, decision and the decision-metric table.

Every estimator here is a single ``agg`` of conditional aggregates over the campaign panel:
partial aggregation on each partition, one row shuffled per partition, one output row. The
four 2x2 cells, the scale-up counts and the per-arm pre-period slopes are fused into that one
pass instead of four filtered scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftkit.config import (
    DECISION_METRIC_TEXT,
    DECISION_RETEST,
    DECISION_SCALE,
    DEFAULT_COEF,
    Coefficients,
)

OUTCOMES = {"bookings": "experience_bookings", "gbv": "gbv", "margin": "contribution_margin"}


def _cell(treated: int, post: int) -> Column:
    return (F.col("treated_market") == treated) & (F.col("post_period") == post)


def did_cells(panel: DataFrame) -> DataFrame:
    """2x2 cell means of the three outcomes, with the cell sizes."""
    return (
        panel.filter(F.col("treated_market").isNotNull() & F.col("post_period").isNotNull())
        .groupBy("treated_market", "post_period")
        .agg(
            F.count(F.lit(1)).alias("n_days"),
            F.avg("experience_bookings").alias("bookings"),
            F.avg("gbv").alias("gbv"),
            F.avg("contribution_margin").alias("margin"),
        )
    )


def did_aggregates(prefix: str = "") -> list[Column]:
    """The conditional aggregates behind ``did_estimate`` (reusable inside other ``agg`` calls).

    Stated as SQL expressions: one parse on the JVM per aggregate instead of one py4j call
    per sub-expression, which keeps plan construction cheap.
    """
    cols = []
    for name, src in OUTCOMES.items():
        for t in (0, 1):
            for p in (0, 1):
                cols.append(F.expr(f"avg(CASE WHEN treated_market = {t} AND post_period = {p} THEN {src} END) "
                                   f"AS {prefix}{name}_t{t}p{p}"))
    tp = "treated_market = 1 AND post_period = 1"
    cols += [
        F.expr(f"count(1) AS {prefix}panel_rows"),
        F.expr(f"count(CASE WHEN {tp} THEN 1 END) AS {prefix}post_treated_days"),
        F.expr(f"coalesce(sum(CASE WHEN {tp} THEN spend END), 0.0D) AS {prefix}total_campaign_spend"),
    ]
    for arm, t in (("treated", 1), ("control", 0)):
        cell = f"treated_market = {t} AND post_period = 0"
        cols.append(F.expr(f"regr_slope(CASE WHEN {cell} THEN experience_bookings END, "
                           f"CASE WHEN {cell} THEN CAST(day_index AS DOUBLE) END) AS {prefix}slope_{arm}"))
    return cols


DID_COLUMNS = [
    "did_daily_incremental_bookings", "did_daily_incremental_gbv", "did_daily_incremental_margin",
    "estimated_incremental_bookings", "estimated_incremental_gbv", "estimated_incremental_margin",
    "total_campaign_spend", "incremental_roas", "cost_per_incremental_booking",
    "pretrend_slope_gap_bookings_per_day",
]


def did_from_aggregates(df: DataFrame, strict: bool = False) -> DataFrame:
    """Finish the estimate from the ``did_aggregates`` columns (keeps other columns)."""
    out = df
    if strict:
        cells = " OR ".join(f"{n}_t{t}p{p} IS NULL" for n in OUTCOMES for t in (0, 1) for p in (0, 1))
        out = out.withColumn("total_campaign_spend", F.expr(
            f"CASE WHEN {cells} THEN raise_error('difference-in-differences: a treated/post cell is empty') "
            f"ELSE total_campaign_spend END"))
    step1 = [f"({n}_t1p1 - {n}_t1p0) - ({n}_t0p1 - {n}_t0p0) AS did_daily_incremental_{n}" for n in OUTCOMES]
    out = out.selectExpr("*", *step1)
    step2 = [f"did_daily_incremental_{n} * post_treated_days AS estimated_incremental_{n}" for n in OUTCOMES]
    out = out.selectExpr("*", *step2)
    return out.selectExpr(
        "*",
        "CASE WHEN total_campaign_spend <> 0 THEN estimated_incremental_gbv / total_campaign_spend END AS incremental_roas",
        "CASE WHEN estimated_incremental_bookings <> 0 THEN total_campaign_spend / estimated_incremental_bookings END "
        "AS cost_per_incremental_booking",
        "slope_treated - slope_control AS pretrend_slope_gap_bookings_per_day",
    )


def did_estimate(panel: DataFrame, strict: bool = False) -> DataFrame:
    """One-row difference-in-differences estimate with scale-up, iROAS and pre-trend gap.

    A missing cell gives NULL effects; ``strict=True`` raises instead.
    """
    return did_from_aggregates(panel.agg(*did_aggregates()), strict).select(*DID_COLUMNS)


def pretrend(panel: DataFrame) -> DataFrame:
    """Pre-period OLS slope of bookings on day per arm, and treated minus control."""
    return (
        panel.filter(F.col("post_period") == 0)
        .agg(
            F.regr_slope(F.when(F.col("treated_market") == 1, F.col("experience_bookings")),
                         F.when(F.col("treated_market") == 1, F.col("day_index").cast("double"))).alias("slope_treated"),
            F.regr_slope(F.when(F.col("treated_market") == 0, F.col("experience_bookings")),
                         F.when(F.col("treated_market") == 0, F.col("day_index").cast("double"))).alias("slope_control"),
        )
        .withColumn("pretrend_slope_gap_bookings_per_day", F.col("slope_treated") - F.col("slope_control"))
    )


def decision(metrics: DataFrame, coef: Coefficients = DEFAULT_COEF) -> DataFrame:
    """Scale only when incremental margin is positive and the pre-trend gap is small."""
    ok = (F.col("estimated_incremental_margin") > 0) & (
        F.abs(F.col("pretrend_slope_gap_bookings_per_day")) < coef.max_pretrend_gap
    )
    return metrics.withColumn("decision", F.when(ok, F.lit(DECISION_SCALE)).otherwise(F.lit(DECISION_RETEST)))


def decision_metrics(listings: DataFrame, demand_panel: DataFrame, marketing: DataFrame) -> DataFrame:
    """Nine-row (metric, value, interpretation) table, in the published order.

    Built as a union of one-row aggregates and an unpivot (``stack``) of the estimate: no
    join, and nothing but nine rows ever reaches a single task.
    """
    text = dict(DECISION_METRIC_TEXT)
    order = {m: i for i, (m, _) in enumerate(DECISION_METRIC_TEXT)}

    def count_row(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit(name).alias("metric"), "value"
        )

    # the panel row count rides along in the estimate's single aggregate pass
    est = did_from_aggregates(marketing.agg(*did_aggregates()))
    did_names = ["marketing_market_day_rows"] + [m for m, _ in DECISION_METRIC_TEXT[3:]]
    stack_args = ", ".join(
        f"'{m}', cast({'panel_rows' if m == 'marketing_market_day_rows' else m} as double)" for m in did_names)
    did_rows = est.selectExpr(f"stack({len(did_names)}, {stack_args}) as (metric, value)")
    rows = (
        count_row(listings, "source_listing_rows")
        .unionByName(count_row(demand_panel, "neighborhood_day_rows"))
        .unionByName(did_rows)
    )
    text_map = F.create_map(*[x for m in text for x in (F.lit(m), F.lit(text[m]))])
    order_map = F.create_map(*[x for m in order for x in (F.lit(m), F.lit(order[m]))])
    return rows.select(
        "metric", "value",
        F.element_at(text_map, F.col("metric")).alias("interpretation"),
        F.element_at(order_map, F.col("metric")).alias("metric_order"),
    )
