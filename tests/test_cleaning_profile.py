"""Edge rows: dirty text, NaN vs NULL, NULL keys, all-NULL groups, fill-before-mean, ties."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from liftkit.config import StudyDesign
from liftkit.operators import cleaning, panel, profile, scoring

RAW = "id long, neighbourhood_group string, neighbourhood string, room_type string, price string, " \
      "number_of_reviews long, last_review string, reviews_per_month string, availability_365 string"


def raw_rows(spark):
    rows = [
        (1, "M", "a", "Entire", "$1,200.00", 3, "2019-05-01", "0.5", "165"),
        (2, "M", "a", "Private", "0", None, "2019-13-01", "", "166"),
        (3, "M", "a", None, "-5", None, "", "nan", ""),
        (4, "M", "b", "Shared", "abc", 2, None, "1.5", "200"),
        (5, "M", "b", "Shared", "nan", 1, "2020-01-02", None, "abc"),
        (6, None, "c", "Entire", "", 0, None, "2", "10"),
        (None, "Q", None, "Entire", "$10", 1, None, "1", "300"),
        (8, "Q", "d", "Entire", "$99,999.00", 1, None, "1", "300"),
    ]
    return spark.createDataFrame(rows, RAW)


def test_clean_values(spark):
    out = {r["id"]: r for r in cleaning.clean_listings(raw_rows(spark)).collect()}
    assert out[1]["price"] == 1200.0 and out[2]["price"] == 0.0 and out[3]["price"] == -5.0
    assert out[4]["price"] is None and out[5]["price"] is None and out[6]["price"] is None  # abc, nan, empty
    assert out[2]["last_review"] is None and out[1]["last_review"].isoformat() == "2019-05-01"
    assert out[3]["reviews_per_month"] == 0.0 and out[2]["reviews_per_month"] == 0.0  # nan and empty -> 0
    assert out[3]["availability_365"] == 0.0 and out[5]["availability_365"] == 0.0


def test_binarize_threshold(spark):
    out = {r["id"]: r["availability_365"] for r in
           cleaning.binarize(cleaning.clean_listings(raw_rows(spark)), "availability_365", 165).collect()}
    assert out[1] == 0 and out[2] == 1 and out[3] == 0


def test_outlier_filter_uses_all_parsed_prices(spark):
    clean = cleaning.clean_listings(raw_rows(spark))
    prices = [r["price"] for r in clean.collect() if r["price"] is not None]
    bound = pd.Series(prices).quantile(0.99)
    kept = sorted(r["price"] for r in cleaning.outlier_filter(clean).collect())
    assert kept == sorted(p for p in prices if 0 < p < bound)


def test_drop_zero_keeps_missing(spark):
    ids = {r["id"] for r in cleaning.drop_zero(cleaning.clean_listings(raw_rows(spark))).collect()}
    assert 2 not in ids and 4 in ids


def test_rollup_semantics(spark):
    clean = cleaning.clean_listings(raw_rows(spark))
    design = StudyDesign(min_listings=1)
    out = {(r["borough"], r["neighbourhood"]): r for r in panel.market_rollup(clean, design).collect()}
    assert ("M", "a") in out and not any(k[0] is None or k[1] is None for k in out)  # NULL keys drop out
    a = out[("M", "a")]
    assert a["listing_count"] == 3
    assert a["room_diversity"] == 2  # NULL room type not counted
    assert a["total_reviews"] == 3
    assert a["review_velocity"] == pytest.approx((0.5 + 0.0 + 0.0) / 3)  # fill before mean
    assert a["avg_price"] == pytest.approx((1200.0 + 0.0 - 5.0) / 3)
    assert a["median_price"] == pytest.approx(0.0)
    assert out[("M", "b")]["avg_price"] is None  # no parsed price
    assert a["experience_category"] == "outdoor_daytrip"


def test_all_null_group_sums_to_zero(spark):
    df = spark.createDataFrame([(1, "X", "x", "r", "$1", None, None, "1", "1")], RAW)
    r = panel.market_rollup(cleaning.clean_listings(df), StudyDesign(min_listings=1)).first()
    assert r["total_reviews"] == 0


def test_null_profile_counts_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    prof = {r["column_name"]: r for r in profile.null_profile(df).collect()}
    assert prof["x"]["missing"] == 2 and prof["s"]["missing"] == 1
    assert prof["x"]["missing_share"] == pytest.approx(2 / 3)
    assert profile.total_missing(df).first()["total_missing"] == 3


def test_distinct_values_and_share(spark):
    df = cleaning.clean_listings(raw_rows(spark))
    vals = {(r["column_name"], r["value"]) for r in profile.distinct_values(df, ["room_type"]).collect()}
    assert vals == {("room_type", v) for v in ["Entire", "Private", "Shared", None]}
    share = {r["room_type"]: r["share"] for r in profile.category_share(df, "room_type").collect()}
    assert share["Entire"] == pytest.approx(4 / 8) and share[None] == pytest.approx(1 / 8)


def test_pct_rank_matches_pandas_with_ties_and_nulls(spark):
    vals = [3.0, 1.0, 3.0, None, 2.0, 3.0, 1.0, None, 5.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = {r["i"]: r["r"] for r in df.select("i", scoring.pct_rank_avg("x").alias("r")).collect()}
    want = pd.Series(vals, dtype="float64").rank(pct=True)
    for i, w in enumerate(want):
        if math.isnan(w):
            assert got[i] is None
        else:
            assert got[i] == pytest.approx(w)


def test_clip_keeps_null(spark):
    from liftkit.functions.signals import clip, floor_zero

    df = spark.createDataFrame([(None,), (150.0,), (-3.0,)], "x double")
    out = [tuple(r) for r in df.select(clip("x", 0, 100).alias("c"), floor_zero("x").alias("f")).collect()]
    assert out == [(None, 0.0), (100.0, 150.0), (0.0, 0.0)]


def test_null_id_is_not_counted(spark):
    rows = [(1, "M", "a", "r", "$10", 1, None, "1", "1"), (None, "M", "a", "r", "$20", 1, None, "1", "1")]
    r = panel.market_rollup(cleaning.clean_listings(spark.createDataFrame(rows, RAW)), StudyDesign(min_listings=1)).first()
    assert r["listing_count"] == 1 and r["avg_price"] == pytest.approx(15.0)


def test_conversion_zero_clicks(spark):
    from liftkit.functions.signals import conversion_rate

    df = spark.createDataFrame([(3.0, 0.0), (3.0, 6.0), (0.0, 0.0)], "b double, c double")
    assert [r[0] for r in df.select(conversion_rate("b", "c")).collect()] == [0.0, 0.5, 0.0]


def test_scores_with_tied_and_missing_signals(spark):
    rows = [("A", 1.0, 5.0, 10.0, 3.0), ("B", 1.0, 5.0, 20.0, 3.0), ("C", 2.0, 6.0, 30.0, 4.0), ("D", None, 7.0, 40.0, 5.0)]
    feats = spark.createDataFrame(
        [(b, d, e, 0.0, 0.0, s, 0.0, 0.0, 0.0, p, 100.0) for b, d, e, s, p in rows],
        "borough string, demand_signal_score double, event_pressure double, intent_index double, "
        "weather_favorability double, available_supply double, baseline_bookings double, avg_gbv double, "
        "avg_margin double, predicted_daily_experience_bookings double, _total_margin double")
    out = {r["borough"]: r for r in scoring.score_markets(feats).collect()}
    pdf = pd.DataFrame(rows, columns=["b", "d", "e", "s", "p"]).astype({"d": "float64"})
    want = 100 * (0.45 * pdf.d.rank(pct=True) + 0.25 * pdf.e.rank(pct=True) + 0.20 * pdf.s.rank(pct=True)
                  + 0.10 * pdf.p.rank(pct=True))
    for i, b in enumerate(pdf.b):
        if math.isnan(want[i]):
            assert out[b]["opportunity_score"] is None
        else:
            assert out[b]["opportunity_score"] == pytest.approx(want[i])
    assert out["D"]["recommended_action"] == "hold / improve signal quality"
    total = sum(r["opportunity_score"] for r in out.values() if r["opportunity_score"] is not None)
    assert out["C"]["expected_incremental_margin"] == pytest.approx(out["C"]["opportunity_score"] * 100.0 / total)


def test_percentile_ranks_of_a_table_match_pandas(spark):
    rows = [(i, None if i % 7 == 0 else float(i % 5), 0.0 if i % 3 else -0.0, i) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, `x.y` double, z double, n int")
    out = scoring.percentile_ranks(df, {"rx": "x.y", "rz": "z", "rn": "n"})
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    got = out.toPandas().sort_values("i")
    import pandas as pd

    src = pd.DataFrame(rows, columns=["i", "x", "z", "n"])
    for name, col in (("rx", "x"), ("rz", "z"), ("rn", "n")):
        pd.testing.assert_series_equal(got[name].reset_index(drop=True), src[col].rank(pct=True), check_names=False)
