"""Difference-in-differences: planted effects, zero effect, missing cells, pre-trend slopes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from liftkit.config import StudyDesign
from liftkit.operators import causal, panel

SCHEMA = ("borough string, day_index int, treated_market int, post_period int, experience_bookings double, "
          "gbv double, contribution_margin double, spend double")


def make_panel(spark, lift=0.0, slope_t=0.0, slope_c=0.0, drop_cell=None, days=20, cutoff=10):
    rows = []
    for b, t in (("T1", 1), ("T2", 1), ("C1", 0), ("C2", 0), ("C3", 0)):
        for d in range(days):
            p = int(d >= cutoff)
            if drop_cell == (t, p):
                continue
            base = 10.0 + (3.0 if t else 0.0) + (slope_t if t else slope_c) * d
            y = base + (lift if (t and p) else 0.0)
            spend = 5.0 if (t and p) else 0.0
            gbv = 100.0 * y
            rows.append((b, d, t, p, y, gbv, 0.22 * gbv - spend, spend))
    return spark.createDataFrame(rows, SCHEMA)


def test_planted_lift(spark):
    r = causal.did_estimate(make_panel(spark, lift=4.0)).first()
    assert r["did_daily_incremental_bookings"] == pytest.approx(4.0)
    assert r["estimated_incremental_bookings"] == pytest.approx(4.0 * 20)  # 2 markets x 10 post days
    assert r["estimated_incremental_gbv"] == pytest.approx(400.0 * 20)
    assert r["total_campaign_spend"] == pytest.approx(5.0 * 20)
    assert r["incremental_roas"] == pytest.approx(8000.0 / 100.0)
    assert r["cost_per_incremental_booking"] == pytest.approx(100.0 / 80.0)
    # margin identity: 0.22 GBV - spend, spend only in treated-post cells
    assert r["estimated_incremental_margin"] == pytest.approx(0.22 * r["estimated_incremental_gbv"] - r["total_campaign_spend"])


def test_zero_lift(spark):
    r = causal.did_estimate(make_panel(spark, lift=0.0)).first()
    assert r["did_daily_incremental_bookings"] == pytest.approx(0.0, abs=1e-12)
    assert r["cost_per_incremental_booking"] is None  # no incremental bookings -> missing


def test_zero_spend_gives_missing_roas(spark):
    df = make_panel(spark, lift=2.0).withColumn("spend", F.lit(0.0))
    assert causal.did_estimate(df).first()["incremental_roas"] is None


def test_missing_cell(spark):
    df = make_panel(spark, lift=1.0, drop_cell=(1, 1))
    r = causal.did_estimate(df).first()
    assert r["did_daily_incremental_bookings"] is None
    with pytest.raises(Exception):
        causal.did_estimate(df, strict=True).collect()


def test_pretrend_slopes(spark):
    df = make_panel(spark, slope_t=0.5, slope_c=0.2)
    r = causal.pretrend(df).first()
    assert r["slope_treated"] == pytest.approx(0.5)
    assert r["slope_control"] == pytest.approx(0.2)
    assert r["pretrend_slope_gap_bookings_per_day"] == pytest.approx(0.3)
    assert causal.did_estimate(df).first()["pretrend_slope_gap_bookings_per_day"] == pytest.approx(0.3)


def test_decision_metrics_order_and_counts(spark):
    mp = make_panel(spark, lift=1.0)
    dm = causal.decision_metrics(mp.limit(7), mp.limit(11), mp).orderBy("metric_order").collect()
    assert [r["metric"] for r in dm][:3] == ["source_listing_rows", "neighborhood_day_rows", "marketing_market_day_rows"]
    assert [r["value"] for r in dm][:3] == [7.0, 11.0, 100.0]
    assert len(dm) == 9


def test_shape_of_balanced_panel(spark):
    design = StudyDesign(start=dt.date(2026, 5, 1), days=90, cutoff_day=46, treated=("Brooklyn", "Queens"))
    markets = spark.createDataFrame([(m,) for m in ["Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island"]], "borough string")
    sc = panel.panel_scaffold(markets, design)
    assert sc.count() == 450
    assert sc.filter("treatment_flag = 1").count() == 2 * 44


def test_calendar_edge_days(spark):
    design = StudyDesign()
    cal = {r["date"].isoformat(): r for r in panel.with_study_days(spark.createDataFrame([("X",)], "m string"), design).collect()}
    assert cal["2026-05-23"]["weekend"] == 1 and cal["2026-05-23"]["holiday"] == 0
    assert cal["2026-05-25"]["weekend"] == 0 and cal["2026-05-25"]["holiday"] == 1
    assert cal["2026-07-04"]["weekend"] == 1 and cal["2026-07-04"]["holiday"] == 1
    assert cal["2026-06-15"]["day_index"] == 45 and cal["2026-06-16"]["day_index"] == 46
    assert max(r["day_index"] for r in cal.values()) == 89 and "2026-07-29" in cal


def test_events_are_pre_aggregated_before_the_market_join(spark):
    """A user holding a third of all events reaches the user -> market join as at most one
    row per (day, event type): the partial aggregate sits below the join."""
    import os

    from liftkit.sources import tables as T

    sf = "/root/testdata/sf0.01"
    if not os.path.exists(sf):
        pytest.skip("test tables absent")
    plan = T.event_funnel_facts(spark, sf)._jdf.queryExecution().executedPlan().toString()
    join_at = min(i for i in (plan.find("BroadcastHashJoin"), plan.find("SortMergeJoin")) if i >= 0)
    # the per-(user, day, type) aggregate appears below (after, in the tree text) the join
    assert "partial_count" in plan[join_at:] and "user_id" in plan[join_at:]


def test_demand_panel_shape_130_by_90(spark):
    """130 sub-markets x 90 days = 11,700 rows; rolled up to 5 markets x 90 days = 450."""
    from liftkit.config import MARKET_SEGMENTS

    boroughs = list(MARKET_SEGMENTS)
    rows = [(boroughs[i % 5], f"n{i}", 25, 100.0, 100.0, 1.0, 10, 120.0, 3, 8.2, 2000.0, "x") for i in range(130)]
    rollup = spark.createDataFrame(
        rows, "borough string, neighbourhood string, listing_count long, avg_price double, median_price double, "
              "review_velocity double, total_reviews long, avg_availability double, room_diversity long, "
              "available_supply double, estimated_lodging_revenue_proxy double, experience_category string")
    dp = panel.demand_panel(rollup, StudyDesign())
    assert dp.count() == 11700
    md = panel.market_day_rollup(dp)
    assert md.count() == 450
    assert md.filter("treated_market = 1 AND post_period = 1").count() == 88
