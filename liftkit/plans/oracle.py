"""DuckDB SQL for every registered query (the cross-engine correctness check).

The SQL is written independently of the Spark code: it states each operator's definition
over the raw tables with CTEs. Doubles are rounded to ten significant digits in both
engines, since summation order differs between them.
"""

from __future__ import annotations

import datetime as dt

from liftkit.config import (
    ACTION_HOLD, ACTION_SCALE, ACTION_TEST, CONTROL_CAMPAIGN_ID, CONTROL_CHANNEL, DECISION_METRIC_TEXT,
    DECISION_RETEST, DECISION_SCALE, DEFAULT_CATEGORY, DEFAULT_COEF as C, DEFAULT_SEGMENT,
    TREATED_CAMPAIGN_ID, TREATED_CHANNEL, RUBRIC, DATE_DERIVED_FIELDS, PASS_SCORE,
)
from liftkit.sources.tables import LISTING_AS_OF, LISTING_MONTHS, TEST_DESIGN as D


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


START = f"DATE '{D.start.isoformat()}'"
END_EXCL = f"DATE '{(D.end + dt.timedelta(days=1)).isoformat()}'"


def seg_case(col: str) -> str:
    arms = " ".join(f"WHEN {col} = {q(k)} THEN {q(v)}" for k, v in D.segments.items())
    return f"(CASE {arms} ELSE {q(DEFAULT_SEGMENT)} END)"


def cat_case(col: str) -> str:
    arms = " ".join(f"WHEN {col} = {q(k)} THEN {q(v)}" for k, v in D.categories)
    return f"(CASE {arms} ELSE {q(DEFAULT_CATEGORY)} END)"


def clip(x: str, lo, hi) -> str:
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE greatest({lo}, least({hi}, {x})) END)"


def dbl(x: str, alias: str) -> str:
    return f"CAST({x} AS DOUBLE) AS {alias}"


def finalize(sql: str, doubles: list[str]) -> str:
    """Round double outputs to ten significant digits, so summation-order differences in the
    last bits compare equal; magnitudes below 1e-12 (cancellation noise around zero) become 0."""
    if not doubles:
        return sql
    repl = ", ".join(f"""CASE WHEN abs("{c}") < 1e-12 THEN 0.0::DOUBLE ELSE CAST(printf('%.9e', "{c}") AS DOUBLE) END AS "{c}\""""
                     for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) oracle_result"


TWO_PI = "2 * pi()"

# -- shared CTEs ------------------------------------------------------------------

CTE = {}

CTE["cm"] = """cm AS (
  SELECT c.c_custkey, r.r_name AS borough, n.n_name AS neighbourhood
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

CTE["ev_facts"] = """pu AS (
  SELECT user_id, CAST(ts AS DATE) AS date, event_type, count(*) AS n, sum(value) AS v
  FROM events GROUP BY user_id, CAST(ts AS DATE), event_type),
facts AS (
  SELECT cm.borough, pu.date,
    CAST(sum(CASE WHEN event_type = 'view' THEN n ELSE 0 END) AS DOUBLE) AS impressions,
    CAST(sum(CASE WHEN event_type = 'click' THEN n ELSE 0 END) AS DOUBLE) AS clicks,
    CAST(sum(CASE WHEN event_type = 'purchase' THEN n ELSE 0 END) AS DOUBLE) AS bookings,
    sum(CASE WHEN event_type = 'purchase' THEN v ELSE 0.0 END) AS gbv,
    sum(CASE WHEN event_type = 'click' THEN v ELSE 0.0 END) AS click_cost,
    CAST(sum(CASE WHEN event_type = 'signup' THEN n ELSE 0 END) AS DOUBLE) AS signals_event,
    CAST(sum(n) AS DOUBLE) AS activity,
    CAST(count(DISTINCT user_id) AS DOUBLE) AS active_units,
    CAST(count(DISTINCT event_type) AS DOUBLE) AS diversity
  FROM pu JOIN cm ON pu.user_id = cm.c_custkey
  GROUP BY cm.borough, pu.date)"""

CTE["days"] = f"""days AS (
  SELECT CAST(d AS DATE) AS date FROM range({START}, {END_EXCL}, INTERVAL 1 DAY) t(d))"""

CTE["scaffold"] = f"""scaffold AS (
  SELECT m.borough, d.date, CAST(datediff('day', {START}, d.date) AS INTEGER) AS day_index,
    CAST(m.borough IN {in_list(D.treated)} AS INTEGER) AS treated_market,
    CAST(datediff('day', {START}, d.date) >= {D.cutoff_day} AS INTEGER) AS post_period
  FROM (SELECT DISTINCT r_name AS borough FROM region WHERE r_name IS NOT NULL) m, days d)"""

_FACT_COLS = ["impressions", "clicks", "bookings", "gbv", "click_cost", "signals_event", "activity",
              "active_units", "diversity"]

CTE["mp"] = f"""mp0 AS (
  SELECT s.*, {', '.join(f'coalesce(f.{c}, 0.0) AS {c}' for c in _FACT_COLS)},
    CAST(s.treated_market = 1 AND s.post_period = 1 AS INTEGER) AS treatment_flag
  FROM scaffold s LEFT JOIN facts f ON s.borough = f.borough AND s.date = f.date),
mp1 AS (
  SELECT *,
    CASE WHEN treatment_flag = 1 THEN click_cost ELSE 0.0 END AS raw_spend,
    CASE WHEN activity > 0 THEN (impressions + clicks) * 100.0 / activity ELSE 0.0 END AS intent_index,
    {clip(f"{C.w0} + {C.w_amp} * sin((day_index + {C.w_shift}) / {C.period_days} * {TWO_PI})", 0.0, 100.0)} AS weather_favorability,
    {clip(f"ln(1 + active_units) * {C.poi_count} + diversity * {C.poi_diversity}", 0.0, 100.0)} AS poi_density
  FROM mp0),
mp AS (
  SELECT date, day_index, borough, {seg_case('borough')} AS traveler_segment, treated_market,
    treatment_flag, 1 - treatment_flag AS holdout_flag, post_period,
    CASE WHEN treatment_flag = 1 THEN {q(TREATED_CAMPAIGN_ID)} ELSE {q(CONTROL_CAMPAIGN_ID)} END AS campaign_id,
    CASE WHEN treatment_flag = 1 THEN {q(TREATED_CHANNEL)} ELSE {q(CONTROL_CHANNEL)} END AS channel,
    greatest(0.0, raw_spend) AS spend, impressions, clicks, bookings AS experience_bookings, gbv,
    gbv * {C.margin_rate} - raw_spend AS contribution_margin,
    CASE WHEN clicks > 0 THEN bookings / clicks ELSE 0.0 END AS conversion_rate,
    {C.w_intent} * intent_index + {C.w_event} * signals_event + {C.w_weather} * weather_favorability
      + {C.w_poi} * poi_density AS demand_signal_score,
    signals_event AS event_pressure, intent_index, weather_favorability, active_units AS available_supply
  FROM mp1)"""


def did_select(src: str = "mp") -> str:
    cells = []
    for name, col in (("bookings", "experience_bookings"), ("gbv", "gbv"), ("margin", "contribution_margin")):
        for t in (0, 1):
            for p in (0, 1):
                cells.append(f"avg(CASE WHEN treated_market = {t} AND post_period = {p} THEN {col} END) AS {name}_t{t}p{p}")
    return f"""SELECT {', '.join(cells)},
    count(CASE WHEN treated_market = 1 AND post_period = 1 THEN 1 END) AS post_treated_days,
    coalesce(sum(CASE WHEN treated_market = 1 AND post_period = 1 THEN spend END), 0.0) AS total_campaign_spend,
    regr_slope(CASE WHEN treated_market = 1 AND post_period = 0 THEN experience_bookings END,
               CASE WHEN treated_market = 1 AND post_period = 0 THEN CAST(day_index AS DOUBLE) END) AS slope_treated,
    regr_slope(CASE WHEN treated_market = 0 AND post_period = 0 THEN experience_bookings END,
               CASE WHEN treated_market = 0 AND post_period = 0 THEN CAST(day_index AS DOUBLE) END) AS slope_control
  FROM {src}"""


CTE["did"] = f"""dagg AS ({did_select()}),
did0 AS (
  SELECT *,
    (bookings_t1p1 - bookings_t1p0) - (bookings_t0p1 - bookings_t0p0) AS did_daily_incremental_bookings,
    (gbv_t1p1 - gbv_t1p0) - (gbv_t0p1 - gbv_t0p0) AS did_daily_incremental_gbv,
    (margin_t1p1 - margin_t1p0) - (margin_t0p1 - margin_t0p0) AS did_daily_incremental_margin
  FROM dagg),
did1 AS (
  SELECT *,
    did_daily_incremental_bookings * post_treated_days AS estimated_incremental_bookings,
    did_daily_incremental_gbv * post_treated_days AS estimated_incremental_gbv,
    did_daily_incremental_margin * post_treated_days AS estimated_incremental_margin
  FROM did0),
did AS (
  SELECT *,
    CASE WHEN total_campaign_spend <> 0 THEN estimated_incremental_gbv / total_campaign_spend END AS incremental_roas,
    CASE WHEN estimated_incremental_bookings <> 0 THEN total_campaign_spend / estimated_incremental_bookings END
      AS cost_per_incremental_booking,
    slope_treated - slope_control AS pretrend_slope_gap_bookings_per_day
  FROM did1)"""

DID_COLS = [
    "did_daily_incremental_bookings", "did_daily_incremental_gbv", "did_daily_incremental_margin",
    "estimated_incremental_bookings", "estimated_incremental_gbv", "estimated_incremental_margin",
    "total_campaign_spend", "incremental_roas", "cost_per_incremental_booking",
    "pretrend_slope_gap_bookings_per_day",
]


def with_ctes(names, body: str) -> str:
    seen = []
    for n in names:
        if n not in seen:
            seen.append(n)
    return "WITH " + ",\n".join(CTE[n] for n in seen) + "\n" + body


OBSERVED = ["cm", "ev_facts", "days", "scaffold", "mp"]

MARKETING_COLS = [
    "date", "day_index", "borough", "traveler_segment", "treated_market", "treatment_flag",
    "holdout_flag", "post_period", "campaign_id", "channel", "spend", "impressions", "clicks",
    "experience_bookings", "gbv", "contribution_margin", "conversion_rate", "demand_signal_score",
    "event_pressure", "intent_index", "weather_favorability", "available_supply",
]
MARKETING_DOUBLES = set(MARKETING_COLS[10:])


def select_cols(cols, doubles, src: str) -> str:
    parts = [dbl(c, c) if c in doubles else c for c in cols]
    return f"SELECT {', '.join(parts)} FROM {src}"


SQL: dict[str, str] = {}

SQL["did_estimate"] = with_ctes(OBSERVED + ["did"], f"SELECT {', '.join(dbl(c, c) for c in DID_COLS)} FROM did")
SQL["panel_facts"] = with_ctes(OBSERVED, select_cols(MARKETING_COLS, MARKETING_DOUBLES, "mp"))


# -- listings chain ---------------------------------------------------------------------

CTE["lst_raw"] = f"""ostat AS (
  SELECT o_custkey, count(*) AS n_orders, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey),
lst_raw AS (
  SELECT c.c_custkey AS id, c.c_name AS name, CAST(c.c_nationkey AS BIGINT) AS host_id,
    'host ' || CAST(c.c_nationkey AS VARCHAR) AS host_name,
    r.r_name AS neighbourhood_group, n.n_name AS neighbourhood, c.c_mktsegment AS room_type,
    '$' || format('{{:,.2f}}', c.c_acctbal) AS price,
    CAST(coalesce(o.n_orders, 0) AS BIGINT) AS number_of_reviews,
    strftime(o.last_order, '%Y-%m-%d') AS last_review,
    CAST(CAST(o.n_orders AS DOUBLE) / {LISTING_MONTHS} AS VARCHAR) AS reviews_per_month,
    CAST(least(datediff('day', CAST(o.last_order AS DATE), DATE '{LISTING_AS_OF}'), 365) AS VARCHAR) AS availability_365
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN ostat o ON c.c_custkey = o.o_custkey)"""


def nan_null(x: str) -> str:
    return f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)"


CTE["lst"] = f"""lst AS (
  SELECT id, name, host_id, host_name, neighbourhood_group, neighbourhood, room_type,
    {nan_null("TRY_CAST(replace(replace(price, '$', ''), ',', '') AS DOUBLE)")} AS price,
    number_of_reviews,
    TRY_CAST(last_review AS DATE) AS last_review,
    coalesce({nan_null("TRY_CAST(reviews_per_month AS DOUBLE)")}, 0.0) AS reviews_per_month,
    coalesce({nan_null("TRY_CAST(availability_365 AS DOUBLE)")}, 0.0) AS availability_365
  FROM lst_raw)"""

CTE["lstf"] = """lstf AS (
  SELECT * FROM lst WHERE price > 0 AND price < (SELECT quantile_cont(price, 0.99) FROM lst))"""

CTE["roll"] = f"""roll0 AS (
  SELECT neighbourhood_group AS borough, neighbourhood, count(id) AS listing_count, avg(price) AS avg_price,
    median(price) AS median_price, avg(reviews_per_month) AS review_velocity,
    CAST(coalesce(sum(number_of_reviews), 0) AS BIGINT) AS total_reviews,
    avg(availability_365) AS avg_availability, count(DISTINCT room_type) AS room_diversity
  FROM lstf WHERE neighbourhood_group IS NOT NULL AND neighbourhood IS NOT NULL
  GROUP BY neighbourhood_group, neighbourhood
  HAVING count(id) >= {D.min_listings}),
roll AS (
  SELECT *, listing_count * (avg_availability / 365.0) AS available_supply,
    avg_price * listing_count * (1 - avg_availability / 365.0) AS estimated_lodging_revenue_proxy,
    {cat_case('borough')} AS experience_category
  FROM roll0)"""


def weekend_sql(d: str) -> str:
    return f"CAST(isodow({d}) >= 6 AS INTEGER)"


def holiday_sql(d: str) -> str:
    return f"CAST(strftime({d}, '%m-%d') IN {in_list(D.holidays)} AS INTEGER)"


def weather_sql(day: str) -> str:
    return clip(f"{C.w0} + {C.w_amp} * sin(({day} + {C.w_shift}) / {C.period_days} * {TWO_PI})", 0.0, 100.0)


CTE["dp"] = f"""dp0 AS (
  SELECT r.*, d.date, CAST(datediff('day', {START}, d.date) AS INTEGER) AS day_index,
    {weekend_sql('d.date')} AS weekend, {holiday_sql('d.date')} AS holiday,
    1.0 + {C.season_amp} * sin(datediff('day', {START}, d.date) / {C.period_days} * {TWO_PI}) AS season,
    CAST(r.borough IN {in_list(D.treated)} AS INTEGER) AS treated_market,
    CAST(datediff('day', {START}, d.date) >= {D.cutoff_day} AS INTEGER) AS post_period,
    {seg_case('r.borough')} AS traveler_segment,
    ln(1 + listing_count) * {C.base_count} + review_velocity * {C.base_velocity} AS base_demand
  FROM roll r, days d),
dp1 AS (
  SELECT *,
    greatest(0.0, {C.ep0} + weekend * {C.ep_weekend} + holiday * {C.ep_holiday} + room_diversity) AS event_pressure,
    {clip(f"{C.in0} + base_demand * {C.in_base} + weekend * {C.in_weekend} + holiday * {C.in_holiday}", C.in_lo, C.in_hi)} AS intent_index,
    {weather_sql('day_index')} AS weather_favorability,
    {clip(f"ln(1 + listing_count) * {C.poi_count} + room_diversity * {C.poi_diversity}", 0.0, 100.0)} AS poi_density,
    greatest(0.0, base_demand * season * (1.0 + {C.org_weekend} * weekend + {C.org_holiday} * holiday)) AS organic_bookings
  FROM dp0),
dp2 AS (
  SELECT *,
    {C.uplift} * treated_market * post_period * (intent_index / {C.uplift_ref}) * (1.0 + weekend * {C.uplift_weekend}) AS campaign_effect,
    {C.w_intent} * intent_index + {C.w_event} * event_pressure + {C.w_weather} * weather_favorability
      + {C.w_poi} * poi_density AS demand_signal_score
  FROM dp1),
dp AS (SELECT *, organic_bookings * (1 + campaign_effect) AS experience_bookings_proxy FROM dp2)"""


CTE["md"] = """md AS (
  SELECT date, day_index, borough, traveler_segment, treated_market, post_period,
    avg(demand_signal_score) AS demand_signal_score, avg(event_pressure) AS event_pressure,
    avg(intent_index) AS intent_index, avg(weather_favorability) AS weather_favorability,
    coalesce(sum(available_supply), 0.0) AS available_supply, avg(review_velocity) AS review_velocity,
    coalesce(sum(experience_bookings_proxy), 0.0) AS baseline_experience_bookings
  FROM dp GROUP BY date, day_index, borough, traveler_segment, treated_market, post_period)"""

CTE["sp"] = f"""sp0 AS (
  SELECT *, CAST(treated_market = 1 AND post_period = 1 AS INTEGER) AS treatment_flag FROM md),
sp1 AS (
  SELECT *, CASE WHEN treatment_flag = 1 THEN {C.spend0} + {C.spend_intent} * intent_index + {C.spend_event} * event_pressure
    ELSE 0.0 END AS raw_spend FROM sp0),
sp2 AS (SELECT *, greatest(0.0, raw_spend * {C.impressions_per_spend}) AS impressions FROM sp1),
sp3 AS (
  SELECT *, greatest(0.0, impressions * ({C.ctr0} + intent_index * {C.ctr_intent})) AS clicks,
    greatest(0.0, baseline_experience_bookings
      + treatment_flag * ({C.inc0} + {C.inc_intent} * intent_index + {C.inc_event} * event_pressure)) AS bookings
  FROM sp2),
sp4 AS (
  SELECT *, bookings * ({C.aov0} + {C.aov_intent} * intent_index
    + CAST(borough = {q(D.premium_market)} AS DOUBLE) * {C.aov_premium}) AS gbv FROM sp3),
sp AS (
  SELECT date, day_index, borough, traveler_segment, treated_market, treatment_flag,
    1 - treatment_flag AS holdout_flag, post_period,
    CASE WHEN treatment_flag = 1 THEN {q(TREATED_CAMPAIGN_ID)} ELSE {q(CONTROL_CAMPAIGN_ID)} END AS campaign_id,
    CASE WHEN treatment_flag = 1 THEN {q(TREATED_CHANNEL)} ELSE {q(CONTROL_CHANNEL)} END AS channel,
    greatest(0.0, raw_spend) AS spend, impressions, clicks, bookings AS experience_bookings, gbv,
    gbv * {C.margin_rate} - raw_spend AS contribution_margin,
    CASE WHEN clicks > 0 THEN bookings / clicks ELSE 0.0 END AS conversion_rate,
    demand_signal_score, event_pressure, intent_index, weather_favorability, available_supply
  FROM sp4)"""

LISTINGS = ["lst_raw", "lst"]
FILTERED = LISTINGS + ["lstf"]
ROLLUP = FILTERED + ["roll"]
DEMAND = ROLLUP + ["days", "dp"]
SCENARIO = DEMAND + ["md", "sp"]

RAW_COLS = ["id", "name", "host_id", "host_name", "neighbourhood_group", "neighbourhood", "room_type", "price",
            "number_of_reviews", "last_review", "reviews_per_month", "availability_365"]
CLEAN_DOUBLES = {"price", "reviews_per_month", "availability_365"}

SQL["clean_price"] = with_ctes(LISTINGS, "SELECT l.id, r.price AS price_text, (l.price) AS price "
                                         "FROM lst l JOIN lst_raw r ON l.id = r.id")
SQL["safe_dates"] = with_ctes(LISTINGS, "SELECT id, last_review FROM lst")
SQL["clean_listings"] = with_ctes(LISTINGS, select_cols(RAW_COLS, CLEAN_DOUBLES, "lst"))
SQL["outlier_filter"] = with_ctes(FILTERED, select_cols(RAW_COLS, CLEAN_DOUBLES, "lstf"))
SQL["drop_zero"] = with_ctes(LISTINGS, "SELECT id, (price) AS price FROM lst WHERE price IS DISTINCT FROM 0")
SQL["binarize"] = with_ctes(LISTINGS, "SELECT id, CASE WHEN availability_365 > 165 THEN 1 ELSE 0 END AS availability_365 FROM lst")
SQL["profile_select"] = with_ctes(LISTINGS, select_cols(
    ["neighbourhood_group", "neighbourhood", "room_type", "price", "number_of_reviews", "reviews_per_month",
     "availability_365"], CLEAN_DOUBLES, "lst"))
SQL["category_share"] = with_ctes(LISTINGS, """SELECT room_type, count(*) AS n,
  (CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM lst)) AS share FROM lst GROUP BY room_type""")
SQL["distinct_values"] = with_ctes(["lst_raw"], """SELECT DISTINCT column_name, value FROM (
  """ + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM lst_raw"
    for c in ["name", "host_name", "neighbourhood_group", "neighbourhood", "room_type", "price", "last_review",
              "reviews_per_month", "availability_365"]) + ") t")

ROLL_COLS = ["borough", "neighbourhood", "listing_count", "avg_price", "median_price", "review_velocity",
             "total_reviews", "avg_availability", "room_diversity", "available_supply",
             "estimated_lodging_revenue_proxy", "experience_category"]
ROLL_DOUBLES = {"avg_price", "median_price", "review_velocity", "avg_availability", "available_supply",
                "estimated_lodging_revenue_proxy"}
SQL["market_rollup"] = with_ctes(ROLLUP, select_cols(ROLL_COLS, ROLL_DOUBLES, "roll"))
SQL["market_category"] = with_ctes(ROLLUP, "SELECT borough, neighbourhood, experience_category FROM roll")

DEMAND_COLS = [
    "date", "day_index", "borough", "neighbourhood", "traveler_segment", "experience_category",
    "listing_count", "available_supply", "avg_price", "review_velocity", "event_pressure",
    "intent_index", "weather_favorability", "poi_density", "weekend", "holiday", "treated_market",
    "post_period", "demand_signal_score", "experience_bookings_proxy",
]
DEMAND_DOUBLES = {"available_supply", "avg_price", "review_velocity", "event_pressure", "intent_index",
                  "weather_favorability", "poi_density", "demand_signal_score", "experience_bookings_proxy",
                  "organic_bookings", "campaign_effect", "season", "base_demand"}
SQL["demand_panel"] = with_ctes(DEMAND, select_cols(DEMAND_COLS, DEMAND_DOUBLES, "dp"))
SQL["demand_signals"] = with_ctes(DEMAND, select_cols(
    ["date", "borough", "neighbourhood", "base_demand", "event_pressure", "intent_index", "weather_favorability",
     "poi_density"], DEMAND_DOUBLES, "dp"))
SQL["demand_score"] = with_ctes(DEMAND, select_cols(["date", "neighbourhood", "demand_signal_score"], DEMAND_DOUBLES, "dp"))
SQL["baseline_forecast"] = with_ctes(DEMAND, select_cols(
    ["date", "neighbourhood", "season", "organic_bookings", "campaign_effect", "experience_bookings_proxy"],
    DEMAND_DOUBLES, "dp"))
MD_COLS = ["date", "day_index", "borough", "traveler_segment", "treated_market", "post_period",
           "demand_signal_score", "event_pressure", "intent_index", "weather_favorability", "available_supply",
           "review_velocity", "baseline_experience_bookings"]
SQL["market_day_rollup"] = with_ctes(DEMAND + ["md"], select_cols(MD_COLS, set(MD_COLS[6:]), "md"))
SQL["scenario_panel"] = with_ctes(SCENARIO, select_cols(MARKETING_COLS, MARKETING_DOUBLES, "sp"))

SQL["segment_lookup"] = with_ctes(["cm"], f"SELECT c_custkey, borough, {seg_case('borough')} AS traveler_segment FROM cm")
SQL["calendar_features"] = f"""SELECT date, CAST(datediff('day', {START}, date) AS INTEGER) AS day_index,
  CAST(isodow(date) - 1 AS INTEGER) AS weekday, {weekend_sql('date')} AS weekend, {holiday_sql('date')} AS holiday,
  strftime(date, '%Y-%m-%d') AS date_iso,
  (1.0 + {C.season_amp} * sin(datediff('day', {START}, date) / {C.period_days} * {TWO_PI})) AS season
FROM (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events) e"""
SQL["panel_scaffold"] = with_ctes(["days", "scaffold"], "SELECT borough, date, day_index, treated_market, post_period FROM scaffold")
SQL["assignment_flags"] = with_ctes(OBSERVED, """SELECT borough, date, treated_market, post_period, treatment_flag,
  holdout_flag, campaign_id, channel FROM mp""")
SQL["kpi_panel"] = with_ctes(OBSERVED, select_cols(
    ["borough", "date", "spend", "clicks", "experience_bookings", "gbv", "contribution_margin", "conversion_rate"],
    MARKETING_DOUBLES, "mp"))


# -- estimate, scores, decision ---------------------------------------------------------

SQL["did_cells"] = with_ctes(OBSERVED, """SELECT treated_market, post_period, count(*) AS n_days,
  (avg(experience_bookings)) AS bookings, (avg(gbv)) AS gbv, (avg(contribution_margin)) AS margin
FROM mp WHERE treated_market IS NOT NULL AND post_period IS NOT NULL GROUP BY treated_market, post_period""")

SQL["pretrend"] = with_ctes(OBSERVED, """SELECT (st) AS slope_treated, (sc) AS slope_control,
  (st - sc) AS pretrend_slope_gap_bookings_per_day
FROM (SELECT
  regr_slope(CASE WHEN treated_market = 1 THEN experience_bookings END, CASE WHEN treated_market = 1 THEN CAST(day_index AS DOUBLE) END) AS st,
  regr_slope(CASE WHEN treated_market = 0 THEN experience_bookings END, CASE WHEN treated_market = 0 THEN CAST(day_index AS DOUBLE) END) AS sc
  FROM mp WHERE post_period = 0) t""")

SQL["decision"] = with_ctes(OBSERVED + ["did"], f"""SELECT (estimated_incremental_margin) AS estimated_incremental_margin,
  (pretrend_slope_gap_bookings_per_day) AS pretrend_slope_gap_bookings_per_day,
  CASE WHEN estimated_incremental_margin > 0 AND abs(pretrend_slope_gap_bookings_per_day) < {C.max_pretrend_gap}
    THEN {q(DECISION_SCALE)} ELSE {q(DECISION_RETEST)} END AS decision
FROM did""")

_dm_parts = []
for i, (m, text) in enumerate(DECISION_METRIC_TEXT):
    if i == 0:
        val = "CAST((SELECT count(*) FROM lstf) AS DOUBLE)"
    elif i == 1:
        val = "CAST((SELECT count(*) FROM dp) AS DOUBLE)"
    elif i == 2:
        val = "CAST((SELECT count(*) FROM mp) AS DOUBLE)"
    else:
        val = f"(SELECT CAST({m} AS DOUBLE) FROM did)"
    _dm_parts.append(f"SELECT {q(m)} AS metric, {val} AS value, {q(text)} AS interpretation, {i} AS metric_order")
CTE["dm"] = "dm AS (\n  " + "\n  UNION ALL ".join(_dm_parts) + ")"
FULL = DEMAND + OBSERVED + ["did", "dm"]
SQL["decision_metrics"] = with_ctes(FULL, "SELECT metric, (value) AS value, interpretation, metric_order FROM dm")

FEAT_DOUBLES = ["demand_signal_score", "event_pressure", "intent_index", "weather_favorability", "available_supply",
                "baseline_bookings", "avg_gbv", "avg_margin"]
CTE["feat"] = """feat AS (
  SELECT borough, avg(demand_signal_score) AS demand_signal_score, avg(event_pressure) AS event_pressure,
    avg(intent_index) AS intent_index, avg(weather_favorability) AS weather_favorability,
    avg(available_supply) AS available_supply, avg(experience_bookings) AS baseline_bookings,
    avg(gbv) AS avg_gbv, avg(contribution_margin) AS avg_margin
  FROM mp WHERE borough IS NOT NULL GROUP BY borough)"""
SQL["opportunity_features"] = with_ctes(OBSERVED + ["feat"], select_cols(["borough"] + FEAT_DOUBLES, set(FEAT_DOUBLES), "feat"))


def pct_rank_sql(x: str) -> str:
    return (f"(CASE WHEN {x} IS NULL THEN NULL ELSE (rank() OVER (ORDER BY {x} ASC NULLS LAST) "
            f"+ (count({x}) OVER (PARTITION BY {x}) - 1) / 2.0) / count({x}) OVER () END)")


CTE["opp"] = f"""opp0 AS (
  SELECT *, baseline_bookings AS predicted_daily_experience_bookings FROM feat),
opp1 AS (
  SELECT *, ({C.s_demand} * {pct_rank_sql('demand_signal_score')} + {C.s_event} * {pct_rank_sql('event_pressure')}
    + {C.s_supply} * {pct_rank_sql('available_supply')}
    + {C.s_predicted} * {pct_rank_sql('predicted_daily_experience_bookings')}) * 100.0 AS opportunity_score
  FROM opp0),
opp2 AS (
  SELECT *, opportunity_score * (SELECT estimated_incremental_margin FROM did) / sum(opportunity_score) OVER ()
    AS expected_incremental_margin FROM opp1),
opp AS (
  SELECT *, CASE WHEN expected_incremental_margin > 0 THEN {q(ACTION_SCALE)}
    WHEN opportunity_score > {C.action_score} THEN {q(ACTION_TEST)} ELSE {q(ACTION_HOLD)} END AS recommended_action,
    CAST(NULL AS DOUBLE) AS rf_holdout_r2
  FROM opp2)"""
SCORE_COLS = ["borough"] + FEAT_DOUBLES + ["predicted_daily_experience_bookings", "opportunity_score",
                                           "expected_incremental_margin", "recommended_action", "rf_holdout_r2"]
SCORE_DOUBLES = set(FEAT_DOUBLES) | {"predicted_daily_experience_bookings", "opportunity_score",
                                     "expected_incremental_margin", "rf_holdout_r2"}
SCORES = OBSERVED + ["did", "feat", "opp"]
SQL["opportunity_scores"] = with_ctes(SCORES, select_cols(SCORE_COLS, SCORE_DOUBLES, "opp"))
SQL["top_market"] = with_ctes(SCORES, select_cols(SCORE_COLS, SCORE_DOUBLES, "opp")
                              + " ORDER BY opportunity_score DESC NULLS LAST, borough ASC LIMIT 1")
SQL["score_frame"] = with_ctes(SCORES, "SELECT borough, (opportunity_score) AS opportunity_score, recommended_action FROM opp")
SQL["pct_rank_avg"] = with_ctes(ROLLUP, f"""SELECT borough, neighbourhood,
  ({pct_rank_sql('avg_price')}) AS avg_price_rank,
  ({pct_rank_sql('room_diversity')}) AS room_diversity_rank,
  ({pct_rank_sql('total_reviews')}) AS total_reviews_rank
FROM roll""")

# -- reports and frames -----------------------------------------------------------------

SQL["report_best_markets"] = with_ctes(SCORES, """SELECT borough, (demand_signal_score) AS demand_signal_score,
  (opportunity_score) AS opportunity_score, recommended_action,
  (expected_incremental_margin) AS expected_incremental_margin FROM opp""")
SQL["report_lift"] = with_ctes(OBSERVED, """SELECT borough, treatment_flag, post_period, count(*) AS days,
  round(avg(experience_bookings), 2) AS avg_daily_bookings, round(avg(gbv), 2) AS avg_daily_gbv,
  round(avg(contribution_margin), 2) AS avg_daily_margin
FROM mp GROUP BY borough, treatment_flag, post_period""")
SQL["report_signals"] = with_ctes(DEMAND, """SELECT borough, round(avg(event_pressure), 2) AS avg_event_pressure,
  round(avg(intent_index), 2) AS avg_intent_index, round(avg(weather_favorability), 2) AS avg_weather_favorability,
  round(avg(review_velocity), 2) AS avg_review_velocity, round(avg(available_supply), 2) AS avg_available_supply
FROM dp GROUP BY borough""")
SQL["report_metrics"] = with_ctes(FULL, "SELECT metric, (value) AS value, interpretation FROM dm")
SQL["trend_frame"] = with_ctes(OBSERVED, """SELECT day_index, treated_market, post_period,
  (avg(experience_bookings)) AS experience_bookings,
  CASE WHEN treated_market = 1 THEN 'Treated markets' WHEN treated_market = 0 THEN 'Control markets' END AS market_group
FROM mp GROUP BY day_index, treated_market, post_period""")
SQL["signal_map_frame"] = with_ctes(DEMAND, """SELECT borough, (avg(intent_index)) AS intent_index,
  (avg(event_pressure)) AS event_pressure, (avg(demand_signal_score)) AS demand_signal_score
FROM dp WHERE borough IS NOT NULL GROUP BY borough""")


# -- quality gates, sources and sinks ---------------------------------------------------------

SQL["table_counts"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}"
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations"])

CTE["wh_counts"] = """whc AS (
  SELECT 'neighborhood_demand_panel' AS table_name, 0 AS position, (SELECT count(*) FROM dp) AS n_rows
  UNION ALL SELECT 'marketing_experiment_panel', 1, (SELECT count(*) FROM mp)
  UNION ALL SELECT 'experience_opportunity_scores', 2, (SELECT count(*) FROM opp)
  UNION ALL SELECT 'decision_metrics', 3, (SELECT count(*) FROM dm)),
gate AS (
  SELECT table_name, 1 AS present, n_rows, CAST(n_rows > 0 AS INTEGER) AS nonempty, 1 AS ok, 1 AS tables_ok FROM whc)"""
WAREHOUSE = FULL + ["feat", "opp", "wh_counts"]
SQL["table_gate"] = with_ctes(WAREHOUSE, "SELECT table_name, present, n_rows, nonempty, ok, tables_ok FROM gate")

_rub_rows = []
for ci, (crit, points, signals) in enumerate(RUBRIC):
    for si, sig in enumerate(signals):
        _rub_rows.append(f"({ci}, {q(crit)}, {points}, {len(signals)}, {si}, {q(sig)})")
CTE["rubric"] = f"""rub(criterion_order, criterion, points, n_signals, signal_order, signal) AS (
  VALUES {', '.join(_rub_rows)}),
hits AS (
  SELECT r.*, CASE WHEN EXISTS (SELECT 1 FROM documents d WHERE contains(lower(d.text), lower(r.signal)))
    THEN 1 ELSE 0 END AS found FROM rub r),
rscore AS (
  SELECT criterion_order, criterion, points, n_signals, CAST(sum(found) AS INTEGER) AS n_found,
    CAST(round_even(points * sum(found) / n_signals, 0) AS INTEGER) AS score,
    coalesce(string_agg(CASE WHEN found = 1 THEN signal END, ', ' ORDER BY signal_order), '') AS found_signals
  FROM hits GROUP BY criterion_order, criterion, points, n_signals)"""
SQL["rubric_score"] = with_ctes(["rubric"], "SELECT * FROM rscore")
SQL["rubric_verdict"] = with_ctes(WAREHOUSE + ["rubric"], f"""SELECT total_score, possible_score, tables_ok,
  CASE WHEN total_score >= {PASS_SCORE} AND tables_ok = 1 THEN 'PASS' ELSE 'NEEDS WORK' END AS verdict
FROM (SELECT CAST(coalesce(sum(score), 0) AS INTEGER) AS total_score, CAST(coalesce(sum(points), 0) AS INTEGER) AS possible_score,
  CAST(coalesce((SELECT min(tables_ok) FROM gate), 0) AS INTEGER) AS tables_ok FROM rscore) t""")

SQL["quality_summary"] = with_ctes(FULL, f"""SELECT (SELECT count(*) FROM lstf) AS raw_listing_rows,
  (SELECT count(*) FROM dp) AS demand_panel_rows, (SELECT count(*) FROM mp) AS marketing_panel_rows,
  (SELECT list_sort(list(DISTINCT borough)) FROM mp WHERE borough IS NOT NULL) AS boroughs,
  [{', '.join(q(x) for x in DATE_DERIVED_FIELDS)}] AS synthetic_fields,
  'customer, nation, region, orders, events' AS source""")

SQL["sink_roundtrip"] = with_ctes(OBSERVED, select_cols(MARKETING_COLS, MARKETING_DOUBLES, "mp"))
SQL["src_listings"] = with_ctes(["lst_raw"], f"SELECT {', '.join(RAW_COLS)} FROM lst_raw")

SQL["warehouse_roundtrip"] = with_ctes(WAREHOUSE, "SELECT table_name, n_rows FROM whc")
SQL["json_roundtrip"] = SQL["quality_summary"]
SQL["corpus_roundtrip"] = """SELECT source, count(*) AS n_documents,
  CAST(sum(length(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))) AS BIGINT) AS n_chars FROM documents GROUP BY source"""
SQL["corpus_whole_files"] = """SELECT source, CAST(sum(length(coalesce(text, '')) + 1) AS BIGINT) AS n_chars,
  CAST(sum(length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1) AS BIGINT) AS n_line_ends
FROM documents GROUP BY source"""
SQL["export_index"] = "SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_index, c_custkey AS id FROM customer"
SQL["roc_auc_exact"] = """WITH p AS (SELECT l.quality AS label, d.n_chars / 7.0 AS score FROM labels l JOIN documents d USING (doc_id)),
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM p),
a AS (SELECT sum(CASE WHEN label = 1 THEN rk END)::DOUBLE AS s, count(*) FILTER (label = 1) AS n1, count(*) FILTER (label <> 1) AS n0 FROM r)
SELECT (s - n1 * (n1 + 1) / 2.0) / (n1 * n0) AS roc_auc, n1 AS n_pos, n0 AS n_neg FROM a"""


# -- features, baselines, nearest neighbours, evaluation ------------------------------------------
# Categorical levels of the test tables' dimensions (region names, nation
# names, market segments), used to spell out the one-hot columns.
REGION_LEVELS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
NATION_LEVELS = sorted(f"NATION_{i}" for i in range(25))
SEGMENT_LEVELS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

_oh = []
for col, prefix, levels in (("neighbourhood_group", "G", REGION_LEVELS), ("neighbourhood", "N", NATION_LEVELS),
                            ("room_type", "R", SEGMENT_LEVELS)):
    for lv in levels:
        _oh.append(f'CAST(coalesce({col} = {q(lv)}, false) AS INTEGER) AS "{prefix}_{lv}"')
CTE["clf"] = f"""clf AS (
  SELECT id, (price) AS price, number_of_reviews, (reviews_per_month) AS reviews_per_month,
    CASE WHEN availability_365 > 165 THEN 1 ELSE 0 END AS label, {', '.join(_oh)}
  FROM lst WHERE price IS DISTINCT FROM 0)"""
SQL["onehot"] = with_ctes(LISTINGS + ["clf"], "SELECT * FROM clf")
SQL["src_export_reread"] = SQL["onehot"]

_num = ["price", "number_of_reviews", "reviews_per_month"]
SQL["standardize"] = with_ctes(LISTINGS, "SELECT id, " + ", ".join(
    f"(CASE WHEN (SELECT stddev_pop({c}) FROM lst) > 0 THEN ({c} - (SELECT avg({c}) FROM lst)) / "
    f"(SELECT stddev_pop({c}) FROM lst) ELSE 0.0 END) AS {c}" for c in _num) + " FROM lst")
SQL["minmax_scale"] = with_ctes(LISTINGS, "SELECT id, " + ", ".join(
    f"(CASE WHEN (SELECT max({c}) FROM lst) > (SELECT min({c}) FROM lst) THEN ({c} - (SELECT min({c}) FROM lst)) / "
    f"((SELECT max({c}) FROM lst) - (SELECT min({c}) FROM lst)) ELSE 0.0 END) AS {c}"
    for c in ["price", "number_of_reviews"]) + " FROM lst")

def hash_key_sql(id_expr: str, seed: int) -> str:
    """The md5-derived 60-bit key of ``ml.hash_key``."""
    return f"('0x' || substr(md5('{seed}:' || CAST({id_expr} AS VARCHAR)), 1, 15))::BIGINT"


def split_sql(id_expr: str, fraction: float, seed: int) -> str:
    return f"CASE WHEN {hash_key_sql(id_expr, seed)} < {int(fraction * 16 ** 15)} THEN 'test' ELSE 'train' END"


SQL["majority_baseline"] = with_ctes(LISTINGS + ["clf"], "").rstrip("\n") + f""",
sp AS (
  SELECT label, {split_sql('id', 0.25, 0)} AS split FROM clf),
maj AS (
  SELECT label AS majority FROM sp WHERE split = 'train' GROUP BY label ORDER BY count(*) DESC, label ASC LIMIT 1)
SELECT (SELECT majority FROM maj) AS majority,
  (avg(CASE WHEN label = (SELECT majority FROM maj) THEN 1.0 ELSE 0.0 END)) AS accuracy,
  count(*) AS n_test
FROM sp WHERE split = 'test'"""

SQL["knn_classify"] = f"""WITH e AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CAST(label AS BIGINT) AS label,
    {split_sql('vec_id', 0.3, 0)} AS split FROM embeddings),
tr AS (SELECT * FROM e WHERE split = 'train'),
pairs AS (
  SELECT q.vec_id AS qid, q.label AS qlabel, q.split, t.vec_id AS tid, t.label AS tlabel, list_distance(q.v, t.v) AS d
  FROM e q, tr t),
rk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, tid) AS r FROM pairs) x WHERE r <= 10),
ks AS (SELECT CAST(k AS INTEGER) AS k FROM range(1, 11) t(k)),
votes AS (
  SELECT rk.qid, rk.qlabel, rk.split, ks.k, rk.tlabel, count(*) AS c FROM rk JOIN ks ON rk.r <= ks.k
  GROUP BY rk.qid, rk.qlabel, rk.split, ks.k, rk.tlabel),
pred AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid, k ORDER BY c DESC, tlabel ASC) AS p FROM votes) x
  WHERE p = 1)
SELECT k, (avg(CASE WHEN split = 'train' THEN CAST(tlabel = qlabel AS DOUBLE) END)) AS train_accuracy,
  (avg(CASE WHEN split = 'test' THEN CAST(tlabel = qlabel AS DOUBLE) END)) AS test_accuracy
FROM pred GROUP BY k"""

CTE["preds"] = """preds AS (
  SELECT l.doc_id AS id, l.quality AS label, round(ln(1 + d.n_chars) / 10.0, 1) AS score,
    CAST(round(ln(1 + d.n_chars) / 10.0, 1) >= 0.7 AS INTEGER) AS prediction
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""
SQL["confusion_matrix"] = with_ctes(["preds"], """SELECT a.c AS actual, p.c AS predicted,
  (SELECT count(*) FROM preds WHERE label = a.c AND prediction = p.c) AS n
FROM (VALUES (0), (1)) a(c), (VALUES (0), (1)) p(c)""")
SQL["accuracy"] = with_ctes(["preds"], "SELECT (avg(CAST(label = prediction AS DOUBLE))) AS accuracy FROM preds")
SQL["f1_score"] = with_ctes(["preds"], """SELECT tp, fp, fn, tn,
  (CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END) AS f1
FROM (SELECT sum(CAST(label = 1 AND prediction = 1 AS BIGINT)) AS tp, sum(CAST(label <> 1 AND prediction = 1 AS BIGINT)) AS fp,
  sum(CAST(label = 1 AND prediction <> 1 AS BIGINT)) AS fn, sum(CAST(label <> 1 AND prediction <> 1 AS BIGINT)) AS tn
  FROM preds) t""")
SQL["classification_report"] = with_ctes(["preds"], "").rstrip("\n") + """,
cls AS (
  SELECT DISTINCT label AS c FROM preds UNION SELECT DISTINCT prediction FROM preds),
per AS (
  SELECT c, (SELECT count(*) FROM preds WHERE label = c) AS support,
    (SELECT count(*) FROM preds WHERE prediction = c) AS n_pred,
    (SELECT count(*) FROM preds WHERE label = c AND prediction = c) AS tp FROM cls),
per2 AS (
  SELECT *, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
    CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM per),
per3 AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM per2)
SELECT CAST(c AS VARCHAR) AS row, (precision) AS precision, (recall) AS recall, (f1) AS f1,
  CAST(support AS BIGINT) AS support FROM per3
UNION ALL SELECT 'accuracy', NULL, NULL, (sum(tp) / sum(support)), CAST(sum(support) AS BIGINT) FROM per3
UNION ALL SELECT 'macro avg', (avg(precision)), (avg(recall)), (avg(f1)), CAST(sum(support) AS BIGINT) FROM per3
UNION ALL SELECT 'weighted avg', (sum(precision * support) / sum(support)), (sum(recall * support) / sum(support)),
  (sum(f1 * support) / sum(support)), CAST(sum(support) AS BIGINT) FROM per3"""

CTE["ranks"] = """rs AS (
  SELECT score AS s, count(*) AS cnt, sum(CAST(label = 1 AS BIGINT)) AS pos FROM preds WHERE score IS NOT NULL GROUP BY score),
rs2 AS (SELECT *, sum(cnt) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - (cnt - 1) / 2.0 AS avg_rank FROM rs)"""
SQL["roc_auc"] = with_ctes(["preds", "ranks"], """SELECT (CASE WHEN n_pos > 0 AND n_neg > 0 THEN
  (rank_sum - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg) END) AS roc_auc, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg
FROM (SELECT sum(pos * avg_rank) AS rank_sum, sum(pos) AS n_pos, sum(cnt - pos) AS n_neg FROM rs2) t""")
SQL["r2_score"] = with_ctes(OBSERVED, """SELECT (CASE WHEN ss_tot > 0 THEN 1 - ss_res / ss_tot END) AS r2 FROM (
  SELECT sum((y - p) * (y - p)) AS ss_res, sum((y - (SELECT avg(experience_bookings) FROM mp)) * (y - (SELECT avg(experience_bookings) FROM mp))) AS ss_tot
  FROM (SELECT experience_bookings AS y, avg(experience_bookings) OVER (PARTITION BY borough) AS p FROM mp) a) t""")


# -- larger funnel: lineitem + orders ------------------------------------------------------------
from liftkit.sources.tables import LINEITEM_DESIGN as LD  # noqa: E402

_L_START = f"DATE '{LD.start.isoformat()}'"
_L_END_EXCL = f"DATE '{(LD.end + dt.timedelta(days=1)).isoformat()}'"
_obs_sql = CTE["scaffold"] + ",\n" + CTE["mp"]
_obs_sql = _obs_sql.replace(START, _L_START).replace(f">= {D.cutoff_day} AS INTEGER", f">= {LD.cutoff_day} AS INTEGER")
_obs_sql = _obs_sql.replace("scaffold", "lscaffold").replace("mp0", "lmp0").replace("mp1", "lmp1").replace(
    "mp AS (", "lmp AS (").replace("LEFT JOIN facts f", "LEFT JOIN lfacts f").replace("m, days d", "m, ldays d")
CTE["li_facts"] = f"""ldays AS (
  SELECT CAST(d AS DATE) AS date FROM range({_L_START}, {_L_END_EXCL}, INTERVAL 1 DAY) t(d)),
om AS (SELECT o.o_orderkey, cm.borough FROM orders o JOIN cm ON o.o_custkey = cm.c_custkey),
lfacts AS (
  SELECT om.borough, CAST(l.l_shipdate AS DATE) AS date,
    sum(l.l_quantity) AS impressions, CAST(count(*) AS DOUBLE) AS clicks,
    CAST(sum(CASE WHEN l.l_returnflag <> 'R' THEN 1 ELSE 0 END) AS DOUBLE) AS bookings,
    sum(l.l_extendedprice * (1 - l.l_discount)) AS gbv, sum(l.l_extendedprice * l.l_tax) AS click_cost,
    CAST(sum(CASE WHEN l.l_discount >= 0.05 THEN 1 ELSE 0 END) AS DOUBLE) AS signals_event,
    CAST(count(*) AS DOUBLE) AS activity, CAST(count(DISTINCT l.l_orderkey) AS DOUBLE) AS active_units,
    CAST(count(DISTINCT l.l_returnflag) AS DOUBLE) AS diversity
  FROM lineitem l JOIN om ON l.l_orderkey = om.o_orderkey
  GROUP BY om.borough, CAST(l.l_shipdate AS DATE)),
{_obs_sql}"""
CTE["ldid"] = CTE["did"].replace("FROM mp", "FROM lmp").replace("dagg", "ldagg").replace("did0", "ldid0").replace(
    "did1", "ldid1").replace("did AS (", "ldid AS (")
SQL["lineitem_did"] = with_ctes(["cm", "li_facts", "ldid"], f"SELECT {', '.join(dbl(c, c) for c in DID_COLS)} FROM ldid")


_RAW_TYPES = {"id": "bigint", "host_id": "bigint", "number_of_reviews": "bigint"}
SQL["null_profile"] = with_ctes(["lst_raw"], "\nUNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{_RAW_TYPES.get(c, 'string')}' AS data_type, "
    f"CAST(count(*) - count({c}) AS BIGINT) AS missing, CAST(count({c}) AS BIGINT) AS non_missing, "
    f"CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS missing_share FROM lst_raw"
    for i, c in enumerate(RAW_COLS)))


SQL["split_hash"] = with_ctes(LISTINGS + ["clf"], f"SELECT id, label, {split_sql('id', 0.3, 200)} AS split FROM clf")
SQL["split_stratified"] = with_ctes(LISTINGS + ["clf"], f"""SELECT id, label,
  CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {hash_key_sql('id', 0)}) - 1
    < round(count(*) OVER (PARTITION BY label) * 0.25) THEN 'test' ELSE 'train' END AS split
FROM clf""")

# Gaussian naive Bayes in closed form: features standardised with training-row statistics,
# per-class prior log(n_c / n), mean and population variance plus 1e-9 x the largest
# training variance; prediction = argmax of the log-likelihood (ties -> smaller class).
_NB_FEATS = ["price", "number_of_reviews", "reviews_per_month"] + [
    f"{p}_{lv}" for p, levels in (("G", REGION_LEVELS), ("N", NATION_LEVELS), ("R", SEGMENT_LEVELS)) for lv in levels]


def _qi(name: str) -> str:
    return '"' + name + '"'


def _nb_sql() -> str:
    fs = _NB_FEATS
    stats = ", ".join(f"avg({_qi(f)}) AS {_qi('mu_' + f)}, stddev_pop({_qi(f)}) AS {_qi('sd_' + f)}" for f in fs)
    zcols = ", ".join(
        f"CASE WHEN st.{_qi('sd_' + f)} > 0 THEN (sp.{_qi(f)} - st.{_qi('mu_' + f)}) / st.{_qi('sd_' + f)} ELSE 0.0 END AS {_qi(f)}"
        for f in fs)
    cls = ", ".join(f"avg({_qi(f)}) AS {_qi('th_' + f)}, var_pop({_qi(f)}) AS {_qi('va_' + f)}" for f in fs)
    eps = "greatest(" + ", ".join(f"var_pop({_qi(f)})" for f in fs) + ") * 1e-9"
    ll = " + ".join(
        f"(-0.5 * ln(2 * pi() * (c.{_qi('va_' + f)} + e.e)) - (z.{_qi(f)} - c.{_qi('th_' + f)}) * (z.{_qi(f)} - c.{_qi('th_' + f)})"
        f" / (2 * (c.{_qi('va_' + f)} + e.e)))" for f in fs)
    return with_ctes(LISTINGS + ["clf"], "").rstrip("\n") + f""",
sp AS (SELECT *, {split_sql('id', 0.25, 0)} AS split FROM clf),
st AS (SELECT {stats} FROM sp WHERE split = 'train'),
z AS (SELECT sp.id, sp.label, sp.split, {zcols} FROM sp, st),
ntr AS (SELECT count(*) AS n FROM z WHERE split = 'train'),
cls AS (SELECT label AS cl, ln(count(*) / (SELECT n FROM ntr)) AS prior, {cls} FROM z WHERE split = 'train' GROUP BY label),
eps AS (SELECT {eps} AS e FROM z WHERE split = 'train'),
ll AS (SELECT z.id, z.label, z.split, c.cl, c.prior + {ll} AS score FROM z, cls c, eps e),
pred AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, cl ASC) AS r FROM ll) x WHERE r = 1)
SELECT 'gaussian_nb' AS model, split, avg(CAST(label = cl AS DOUBLE)) AS accuracy FROM pred GROUP BY split"""


SQL["gnb_classify"] = _nb_sql()


# Zero gradient: the objective's minimum, one row per model and coefficient.
SQL["logreg_optimality"] = with_ctes(LISTINGS + ["clf"], "").rstrip("\n") + f""",
tr AS (SELECT count(*) AS n FROM clf WHERE {split_sql('id', 0.25, 0)} = 'train'),
co AS (SELECT unnest([{', '.join(q(f) for f in _NB_FEATS + ['(intercept)'])}]) AS coefficient)
SELECT m.model, co.coefficient, tr.n AS n_train, 0.0::DOUBLE AS gradient
FROM (VALUES ('logreg_C1.0'), ('logreg_C0.1')) m(model), co, tr"""
SQL["cross_val_optimality"] = with_ctes(LISTINGS + ["clf"], "").rstrip("\n") + f""",
f AS (SELECT CAST(floor({hash_key_sql('id', 7)} / {float(16 ** 15)!r} * 5) AS INTEGER) AS fold FROM clf),
k AS (SELECT CAST(i AS INTEGER) AS k FROM range(5) t(i)),
tr AS (SELECT k, (SELECT count(*) FROM f WHERE fold <> k) AS n FROM k),
co AS (SELECT unnest([{', '.join(q(f) for f in _NB_FEATS + ['(intercept)'])}]) AS coefficient)
SELECT 'fold' || tr.k AS model, co.coefficient, tr.n AS n_train, 0.0::DOUBLE AS gradient FROM tr, co"""


def _tree_sql(depth: int = 2) -> str:
    """Exact Gini search by level: every distinct value of every feature in every node."""
    listed = ", ".join(f"coalesce({_qi(f)}::DOUBLE, (SELECT avg({_qi(f)}) FROM sp WHERE split = 'train'))" if f in _num
                       else f"{_qi(f)}::DOUBLE" for f in _NB_FEATS)
    sql = with_ctes(LISTINGS + ["clf"], "").rstrip("\n") + f""",
sp AS (SELECT *, {split_sql('id', 0.3, 200)} AS split FROM clf),
x AS (SELECT id, label, split, [{listed}] AS f FROM sp),
melt AS MATERIALIZED (SELECT id, label, CAST(i AS INTEGER) AS feature, f[i + 1] AS value FROM x, range({len(_NB_FEATS)}) r(i) WHERE split = 'train'),
asg0 AS (SELECT id, 1 AS node FROM x)"""
    for d in range(depth):
        sql += f""",
cell{d} AS (SELECT node, feature, value, count(*)::DOUBLE AS n1, sum(label)::DOUBLE AS s1 FROM melt JOIN asg{d} USING (id)
  WHERE node >= {2 ** d} GROUP BY ALL),
side{d} AS (SELECT node, feature, value, sum(n1) OVER u AS nl, sum(s1) OVER u AS sl, lead(value) OVER (PARTITION BY node, feature ORDER BY value) AS above,
  sum(n1) OVER (PARTITION BY node, feature) AS n, sum(s1) OVER (PARTITION BY node, feature) AS s FROM cell{d}
  WINDOW u AS (PARTITION BY node, feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
best{d} AS MATERIALIZED (SELECT * FROM (SELECT *, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) AS score,
    row_number() OVER (PARTITION BY node ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, feature, value) AS r
  FROM side{d} WHERE above IS NOT NULL AND n * s > s * s) t WHERE r = 1),
asg{d + 1} AS MATERIALIZED (SELECT x.id, CASE WHEN b.node IS NULL THEN a.node WHEN x.f[b.feature + 1] <= (b.value + b.above) / 2 THEN 2 * a.node
    ELSE 2 * a.node + 1 END AS node FROM x JOIN asg{d} a USING (id) LEFT JOIN best{d} b ON a.node = b.node)"""
    return sql


SQL["tree_classify"] = _tree_sql() + """,
leaf AS (SELECT node, avg(label) AS p FROM x JOIN asg2 USING (id) WHERE split = 'train' GROUP BY node)
SELECT 'decision_tree_depth2' AS model, split, avg(CAST((p > 0.5)::INTEGER = label AS DOUBLE)) AS accuracy
FROM x JOIN asg2 USING (id) JOIN leaf USING (node) GROUP BY split"""
SQL["tree_importance"] = _tree_sql() + f""",
gain AS (SELECT feature, sum(score - s * s / n) AS g FROM (SELECT * FROM best0 UNION ALL SELECT * FROM best1) b GROUP BY feature),
nm AS (SELECT unnest([{', '.join(q(f) for f in _NB_FEATS)}]) AS feature, CAST(unnest(range({len(_NB_FEATS)})) AS INTEGER) AS i)
SELECT nm.feature, coalesce(g / (SELECT sum(g) FROM gain), 0.0)::DOUBLE AS importance FROM nm LEFT JOIN gain ON gain.feature = nm.i"""


def _forest_roots_sql() -> str:
    """Hashed Poisson(1) bootstraps and the exact least-squares split of each root."""
    from liftkit.operators.scoring import SIGNALS
    from liftkit.operators.trees import poisson_cuts

    key = "borough || '|' || strftime(date, '%Y-%m-%d')"
    h = "('0x' || substr(md5(CAST(4200000 + tree AS VARCHAR) || ':' || k), 1, 15))::BIGINT"
    drawn = " + ".join(f"CAST(h >= {c} AS INTEGER)" for c in poisson_cuts())
    return with_ctes(OBSERVED, "").rstrip("\n") + f""",
x AS (SELECT {key} AS k, experience_bookings::DOUBLE AS y, [{', '.join(f'round({c}, 9)' for c in SIGNALS)}] AS f FROM mp
  WHERE {split_sql(key, 0.25, 42)} = 'train'),
w0 AS (SELECT x.*, CAST(t.i AS INTEGER) AS tree FROM x, range(100) t(i)),
w AS MATERIALIZED (SELECT *, ({drawn})::DOUBLE AS w FROM (SELECT *, {h} AS h FROM w0) a),
root AS (SELECT tree, sum(w) AS n, sum(w * y) AS s, sum(w * y * y) AS q FROM w GROUP BY tree),
cell AS (SELECT tree, feature, value, sum(w) AS n1, sum(w * y) AS s1 FROM (
  SELECT tree, w, y, CAST(i AS INTEGER) AS feature, f[i + 1] AS value FROM w, range({len(SIGNALS)}) r(i) WHERE w > 0) m GROUP BY ALL),
side AS (SELECT tree, feature, value, sum(n1) OVER u AS nl, sum(s1) OVER u AS sl,
  lead(value) OVER (PARTITION BY tree, feature ORDER BY value) AS above FROM cell
  WINDOW u AS (PARTITION BY tree, feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
best AS (SELECT * FROM (SELECT side.*, row_number() OVER (PARTITION BY tree
    ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, feature, value) AS r
  FROM side JOIN root USING (tree) WHERE above IS NOT NULL AND nl >= 4 AND n - nl >= 4 AND n * q > s * s) t WHERE r = 1)
SELECT root.tree, CAST(n AS BIGINT) AS n_rows, s / n AS label_mean, [{', '.join(q(c) for c in SIGNALS)}][best.feature + 1] AS feature,
  (best.value + best.above) / 2 AS threshold FROM root LEFT JOIN best USING (tree)"""


SQL["forest_roots"] = _forest_roots_sql()


# Double-valued output columns per key (checked against the Spark schema by tests/test_oracle.py).
DOUBLE_COLUMNS = {
    'gnb_classify': ['accuracy'],
    'tree_classify': ['accuracy'],
    'forest_roots': ['label_mean', 'threshold'],
    'tree_importance': ['importance'],
    'logreg_optimality': ['gradient'],
    'cross_val_optimality': ['gradient'],
    'null_profile': ['missing_share'],
    'accuracy': ['accuracy'],
    'assignment_flags': [],
    'baseline_forecast': ['season', 'organic_bookings', 'campaign_effect', 'experience_bookings_proxy'],
    'binarize': [],
    'calendar_features': ['season'],
    'category_share': ['share'],
    'classification_report': ['precision', 'recall', 'f1'],
    'clean_listings': ['price', 'reviews_per_month', 'availability_365'],
    'clean_price': ['price'],
    'confusion_matrix': [],
    'decision': ['estimated_incremental_margin', 'pretrend_slope_gap_bookings_per_day'],
    'decision_metrics': ['value'],
    'demand_panel': ['available_supply', 'avg_price', 'review_velocity', 'event_pressure', 'intent_index', 'weather_favorability', 'poi_density', 'demand_signal_score', 'experience_bookings_proxy'],
    'demand_score': ['demand_signal_score'],
    'demand_signals': ['base_demand', 'event_pressure', 'intent_index', 'weather_favorability', 'poi_density'],
    'did_cells': ['bookings', 'gbv', 'margin'],
    'did_estimate': ['did_daily_incremental_bookings', 'did_daily_incremental_gbv', 'did_daily_incremental_margin', 'estimated_incremental_bookings', 'estimated_incremental_gbv', 'estimated_incremental_margin', 'total_campaign_spend', 'incremental_roas', 'cost_per_incremental_booking', 'pretrend_slope_gap_bookings_per_day'],
    'distinct_values': [],
    'drop_zero': ['price'],
    'f1_score': ['f1'],
    'knn_classify': ['train_accuracy', 'test_accuracy'],
    'kpi_panel': ['spend', 'clicks', 'experience_bookings', 'gbv', 'contribution_margin', 'conversion_rate'],
    'lineitem_did': ['did_daily_incremental_bookings', 'did_daily_incremental_gbv', 'did_daily_incremental_margin', 'estimated_incremental_bookings', 'estimated_incremental_gbv', 'estimated_incremental_margin', 'total_campaign_spend', 'incremental_roas', 'cost_per_incremental_booking', 'pretrend_slope_gap_bookings_per_day'],
    'majority_baseline': ['accuracy'],
    'market_category': [],
    'market_day_rollup': ['demand_signal_score', 'event_pressure', 'intent_index', 'weather_favorability', 'available_supply', 'review_velocity', 'baseline_experience_bookings'],
    'market_rollup': ['avg_price', 'median_price', 'review_velocity', 'avg_availability', 'available_supply', 'estimated_lodging_revenue_proxy'],
    'minmax_scale': ['price', 'number_of_reviews'],
    'onehot': ['price', 'reviews_per_month'],
    'opportunity_features': ['demand_signal_score', 'event_pressure', 'intent_index', 'weather_favorability', 'available_supply', 'baseline_bookings', 'avg_gbv', 'avg_margin'],
    'opportunity_scores': ['demand_signal_score', 'event_pressure', 'intent_index', 'weather_favorability', 'available_supply', 'baseline_bookings', 'avg_gbv', 'avg_margin', 'predicted_daily_experience_bookings', 'opportunity_score', 'expected_incremental_margin', 'rf_holdout_r2'],
    'outlier_filter': ['price', 'reviews_per_month', 'availability_365'],
    'panel_facts': ['spend', 'impressions', 'clicks', 'experience_bookings', 'gbv', 'contribution_margin', 'conversion_rate', 'demand_signal_score', 'event_pressure', 'intent_index', 'weather_favorability', 'available_supply'],
    'panel_scaffold': [],
    'pct_rank_avg': ['avg_price_rank', 'room_diversity_rank', 'total_reviews_rank'],
    'pretrend': ['slope_treated', 'slope_control', 'pretrend_slope_gap_bookings_per_day'],
    'profile_select': ['price', 'reviews_per_month', 'availability_365'],
    'quality_summary': [],
    'r2_score': ['r2'],
    'report_best_markets': ['demand_signal_score', 'opportunity_score', 'expected_incremental_margin'],
    'report_lift': ['avg_daily_bookings', 'avg_daily_gbv', 'avg_daily_margin'],
    'report_metrics': ['value'],
    'report_signals': ['avg_event_pressure', 'avg_intent_index', 'avg_weather_favorability', 'avg_review_velocity', 'avg_available_supply'],
    'roc_auc': ['roc_auc'],
    'roc_auc_exact': ['roc_auc'],
    'rubric_score': [],
    'rubric_verdict': [],
    'safe_dates': [],
    'scenario_panel': ['spend', 'impressions', 'clicks', 'experience_bookings', 'gbv', 'contribution_margin', 'conversion_rate', 'demand_signal_score', 'event_pressure', 'intent_index', 'weather_favorability', 'available_supply'],
    'score_frame': ['opportunity_score'],
    'segment_lookup': [],
    'signal_map_frame': ['intent_index', 'event_pressure', 'demand_signal_score'],
    'sink_roundtrip': ['spend', 'impressions', 'clicks', 'experience_bookings', 'gbv', 'contribution_margin', 'conversion_rate', 'demand_signal_score', 'event_pressure', 'intent_index', 'weather_favorability', 'available_supply'],
    'src_export_reread': ['price', 'reviews_per_month'],
    'src_listings': [],
    'standardize': ['price', 'number_of_reviews', 'reviews_per_month'],
    'table_counts': [],
    'table_gate': [],
    'top_market': ['demand_signal_score', 'event_pressure', 'intent_index', 'weather_favorability', 'available_supply', 'baseline_bookings', 'avg_gbv', 'avg_margin', 'predicted_daily_experience_bookings', 'opportunity_score', 'expected_incremental_margin', 'rf_holdout_r2'],
    'trend_frame': ['experience_bookings'],
}


ORACLE = {k: finalize(v, DOUBLE_COLUMNS.get(k, [])) for k, v in SQL.items()}
