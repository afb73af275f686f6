"""Golden rows recomputed from the published five-market score table and decision metrics."""


import pytest
from pyspark.sql import functions as F

from liftkit.config import ACTION_HOLD, ACTION_TEST, DECISION_RETEST
from liftkit.operators import causal, scoring

# Published per-market features and results (fixed values).
FEATURES = [
    # borough, demand_signal_score, event_pressure, available_supply, predicted bookings
    ("Manhattan", 73.68286477296459, 12.384871637338911, 6451.038356164384, 813.3035245676697),
    ("Brooklyn", 72.52486888688841, 12.360042179789664, 5434.8794520547945, 1075.921020080179),
    ("Queens", 72.02484271937408, 12.328460453817803, 2146.591780821918, 1105.6636964486154),
    ("Bronx", 68.00187293179948, 12.222221334131698, 349.386301369863, 476.39060631063455),
    ("Staten Island", 67.31536783035176, 11.801477073022046, 97.1917808219178, 125.6687683147691),
]
EXPECTED = {
    "Manhattan": (96.0, -64149.43851549675, ACTION_TEST),
    "Brooklyn": (80.0, -53457.86542958062, ACTION_TEST),
    "Queens": (64.0, -42766.2923436645, ACTION_HOLD),
    "Bronx": (40.0, -26728.93271479031, ACTION_HOLD),
    "Staten Island": (20.0, -13364.466357395155, ACTION_HOLD),
}
TOTAL_MARGIN = -200466.99536092734
METRICS = {
    "estimated_incremental_bookings": 2922.507266879409,
    "estimated_incremental_gbv": 460168.73199334607,
    "estimated_incremental_margin": -200466.99536092734,
    "incremental_roas": 1.5252318645333702,
    "cost_per_incremental_booking": 103.2346847580695,
    "pretrend_slope_gap_bookings_per_day": 0.08705729175156313,
}


def test_scores_match_published_rows(spark):
    rows = [(b, d, e, 0.0, 0.0, s, 0.0, 0.0, 0.0, p, TOTAL_MARGIN) for b, d, e, s, p in FEATURES]
    feats = spark.createDataFrame(
        rows,
        "borough string, demand_signal_score double, event_pressure double, intent_index double, "
        "weather_favorability double, available_supply double, baseline_bookings double, avg_gbv double, "
        "avg_margin double, predicted_daily_experience_bookings double, _total_margin double",
    )
    out = {r["borough"]: r for r in scoring.score_markets(feats, r2=0.9817972783507989).collect()}
    for b, (score, margin, action) in EXPECTED.items():
        assert out[b]["opportunity_score"] == pytest.approx(score, abs=1e-9)
        assert out[b]["expected_incremental_margin"] == pytest.approx(margin, rel=1e-12)
        assert out[b]["recommended_action"] == action
    assert sum(r["expected_incremental_margin"] for r in out.values()) == pytest.approx(TOTAL_MARGIN, abs=1.5e-9)


def test_metric_identities():
    spend = METRICS["estimated_incremental_gbv"] / METRICS["incremental_roas"]
    assert spend == pytest.approx(301704.12, abs=0.01)
    assert spend / METRICS["estimated_incremental_bookings"] == pytest.approx(METRICS["cost_per_incremental_booking"], rel=1e-12)
    # spend is zero outside treated-post cells and never negative: margin = 0.22 GBV - spend
    assert 0.22 * METRICS["estimated_incremental_gbv"] - spend == pytest.approx(METRICS["estimated_incremental_margin"], abs=1e-6)


def test_decision_on_published_metrics(spark):
    m = spark.createDataFrame([tuple(METRICS.values())], ", ".join(f"{k} double" for k in METRICS))
    assert causal.decision(m).first()["decision"] == DECISION_RETEST


def test_top_market_tiebreak(spark):
    s = spark.createDataFrame([("B", 50.0), ("A", 50.0), ("C", 10.0)], "borough string, opportunity_score double")
    assert scoring.top_market(s).first()["borough"] == "A"
