"""Percentile rank with averaged ties, opportunity scores and the top market.

The scores are computed over the per-market table (one row per market), so the
un-partitioned windows here see one row per market, never raw panel rows. Tables of any
size are ranked by ``percentile_ranks``, which never sorts all rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftkit.config import ACTION_HOLD, ACTION_SCALE, ACTION_TEST, DEFAULT_COEF, Coefficients
from liftkit.functions.clean import quoted
from liftkit.operators import ranking

SIGNALS = ["demand_signal_score", "event_pressure", "intent_index", "weather_favorability", "available_supply"]


def pct_rank_avg(col: str) -> Column:
    """Percentile rank, ties get their average rank, divided by the non-missing count.

    NULL stays NULL. Use on tables with a bounded number of rows (it is a global window).
    """
    x = F.col(col)
    order = Window.orderBy(x.asc_nulls_last())
    peers = Window.partitionBy(x)
    whole = Window.partitionBy()
    avg_rank = F.rank().over(order) + (F.count(x).over(peers) - 1) / 2.0
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(avg_rank / F.count(x).over(whole))


def percentile_ranks(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """``df`` plus a column ``name`` for each ``{name: column}``: the percentile rank of
    ``pct_rank_avg``, for tables of any size. All columns are ranked in one pass: one row per
    (column, value) with its count, running totals through ``ranking``, joined back by value.
    Values are compared as doubles; a missing value has a missing rank."""
    cols = list(names.values())
    cells = [F.struct(F.lit(i).alias("_c"), F.col(quoted(c)).cast("double").alias("_x")) for i, c in enumerate(cols)]
    per = df.select(F.explode(F.array(*cells)).alias("_cell")).select("_cell.*").filter(F.col("_x").isNotNull())
    per = per.groupBy("_c", "_x").agg(F.count(F.lit(1)).alias("_cnt"))
    ranks = ranking.ordered_offsets(per, "_x", ["_c"], weight=F.col("_cnt")).select(
        "_c", "_x", ((F.col("_before") + (F.col("_cnt") + 1) / 2.0) / F.col("_n")).alias("_rank"))
    out = df
    for i, (name, col) in enumerate(names.items()):
        one = ranks.filter(F.col("_c") == i).select(F.col("_x").alias(f"_x_{i}"), F.col("_rank").alias(name))
        out = out.join(one, F.col(quoted(col)).cast("double") == F.col(f"_x_{i}"), "left").drop(f"_x_{i}")
    return out


def market_features(panel: DataFrame, with_did: bool = False) -> DataFrame:
    """Per-market means of the five signals and the three outcomes.

    With ``with_did`` the same pass also carries, per market, the conditional sums the
    difference-in-differences needs, so the whole-panel estimate can be finished with a
    window over markets instead of a join against a separate one-row result.
    """
    aggs = [F.avg(c).alias(c) for c in SIGNALS] + [
        F.avg("experience_bookings").alias("baseline_bookings"),
        F.avg("gbv").alias("avg_gbv"),
        F.avg("contribution_margin").alias("avg_margin"),
    ]
    if with_did:
        for name, src in (("bookings", "experience_bookings"), ("gbv", "gbv"), ("margin", "contribution_margin")):
            for t in (0, 1):
                for p in (0, 1):
                    cell = (F.col("treated_market") == t) & (F.col("post_period") == p)
                    aggs.append(F.sum(F.when(cell, F.col(src))).alias(f"_s_{name}_t{t}p{p}"))
                    if name == "bookings":
                        aggs.append(F.count(F.when(cell, F.lit(1))).alias(f"_n_t{t}p{p}"))
        aggs.append(F.sum(F.when((F.col("treated_market") == 1) & (F.col("post_period") == 1), F.col("spend"))).alias("_spend"))
    return panel.filter(F.col("borough").isNotNull()).groupBy("borough").agg(*aggs)


def _global_margin(features: DataFrame) -> Column:
    """Estimated incremental margin of the whole panel from per-market cell sums."""
    every = Window.partitionBy()

    def cell_mean(t, p):
        return F.sum(f"_s_margin_t{t}p{p}").over(every) / F.sum(f"_n_t{t}p{p}").over(every)

    did = (cell_mean(1, 1) - cell_mean(1, 0)) - (cell_mean(0, 1) - cell_mean(0, 0))
    return did * F.sum("_n_t1p1").over(every)


SCORE_COLUMNS = SIGNALS + [
    "baseline_bookings", "avg_gbv", "avg_margin", "predicted_daily_experience_bookings",
    "opportunity_score", "expected_incremental_margin", "recommended_action", "rf_holdout_r2",
]


def opportunity_scores(panel: DataFrame, predicted: DataFrame | None = None, r2: float | None = None,
                       coef: Coefficients = DEFAULT_COEF) -> DataFrame:
    """Per-market opportunity score (0-100), margin split and recommended action.

    ``predicted`` is an optional (borough, predicted_daily_experience_bookings) frame, e.g.
    forest predictions; without it the market's mean bookings stand in. The incremental margin
    is the difference-in-differences estimate over the same panel.
    """
    feats = market_features(panel, with_did=True)
    if predicted is None:
        feats = feats.withColumn("predicted_daily_experience_bookings", F.col("baseline_bookings"))
    else:
        feats = feats.join(predicted.select("borough", "predicted_daily_experience_bookings"), "borough", "left")
    return score_markets(feats.withColumn("_total_margin", _global_margin(feats)), r2, coef)


def score_markets(feats: DataFrame, r2: float | None = None, coef: Coefficients = DEFAULT_COEF,
                  total_margin_col: str = "_total_margin") -> DataFrame:
    """Score a per-market feature table carrying a total-margin column.

    The table has one row per market, so it is moved to a single partition once: every rank
    window below then runs as a local sort, instead of one exchange per window.
    """
    feats = feats.coalesce(1)
    score = (
        coef.s_demand * pct_rank_avg("demand_signal_score")
        + coef.s_event * pct_rank_avg("event_pressure")
        + coef.s_supply * pct_rank_avg("available_supply")
        + coef.s_predicted * pct_rank_avg("predicted_daily_experience_bookings")
    ) * 100.0
    out = feats.withColumn("opportunity_score", score)
    out = out.withColumn(
        "expected_incremental_margin",
        F.col("opportunity_score") * F.col(total_margin_col) / F.sum("opportunity_score").over(Window.partitionBy()),
    )
    out = out.withColumn(
        "recommended_action",
        F.when(F.col("expected_incremental_margin") > 0, F.lit(ACTION_SCALE))
        .when(F.col("opportunity_score") > coef.action_score, F.lit(ACTION_TEST))
        .otherwise(F.lit(ACTION_HOLD)),
    )
    out = out.withColumn("rf_holdout_r2", F.lit(r2).cast("double"))
    return out.select("borough", *SCORE_COLUMNS)


def top_market(scores: DataFrame) -> DataFrame:
    """Best market by score; ties broken by market name."""
    return scores.orderBy(F.col("opportunity_score").desc_nulls_last(), F.col("borough").asc()).limit(1)
