"""Calendar, signal, response and KPI expressions.

All are plain ``Column`` arithmetic, so they stay inside whole-stage codegen. The signal and
response formulas are the published ones at zero noise; coefficients come from
``Coefficients``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from liftkit.config import DEFAULT_COEF, Coefficients
from liftkit.functions.clean import col_of


# -- generic -----------------------------------------------------------------

def clip(x, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (``greatest``/``least`` alone would drop it)."""
    x = col_of(x)
    out = x
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(out)


def floor_zero(x) -> Column:
    """``max(0, x)``: missing -> 0, as Python's ``max`` over a missing draw is never taken."""
    return F.greatest(F.lit(0.0), col_of(x))


def safe_ratio(num, den, zero: float | None = 0.0) -> Column:
    """num / den when den > 0, else ``zero`` (NULL when ``zero`` is None)."""
    num, den = col_of(num), col_of(den)
    fallback = F.lit(None).cast("double") if zero is None else F.lit(float(zero))
    return F.when(den > 0, num / den).otherwise(fallback)


def lookup(key, mapping: dict, default: str) -> Column:
    """Dictionary lookup with a default, as a map literal (no join, no shuffle)."""
    if not mapping:
        return F.lit(default)
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.element_at(F.create_map(*pairs), col_of(key)), F.lit(default))


def first_match(key, branches, default: str) -> Column:
    """Chained ``when``: first equal key wins, else default."""
    key = col_of(key)
    out = None
    for k, v in branches:
        out = F.when(key == F.lit(k), F.lit(v)) if out is None else out.when(key == F.lit(k), F.lit(v))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


# -- calendar ----------------------------------------------------------------

def weekend_flag(date) -> Column:
    """1 on Saturday and Sunday (Monday = 0 numbering)."""
    return (F.weekday(col_of(date)) >= 5).cast("int")


def holiday_flag(date, holidays) -> Column:
    """Year-free month-day match."""
    return F.date_format(col_of(date), "MM-dd").isin(list(holidays)).cast("int")


def season(day, coef: Coefficients = DEFAULT_COEF) -> Column:
    return 1.0 + coef.season_amp * F.sin(col_of(day) / coef.period_days * 2.0 * math.pi)


# -- signals -----------------------------------------------------------------

def base_demand(count, velocity, coef: Coefficients = DEFAULT_COEF) -> Column:
    return F.log1p(col_of(count)) * coef.base_count + col_of(velocity) * coef.base_velocity


def event_pressure(weekend, holiday, diversity, coef: Coefficients = DEFAULT_COEF) -> Column:
    raw = coef.ep0 + col_of(weekend) * coef.ep_weekend + col_of(holiday) * coef.ep_holiday + col_of(diversity)
    return floor_zero(raw)


def intent_index(base, weekend, holiday, coef: Coefficients = DEFAULT_COEF) -> Column:
    raw = coef.in0 + col_of(base) * coef.in_base + col_of(weekend) * coef.in_weekend + col_of(holiday) * coef.in_holiday
    return clip(raw, coef.in_lo, coef.in_hi)


def weather_favorability(day, coef: Coefficients = DEFAULT_COEF) -> Column:
    raw = coef.w0 + coef.w_amp * F.sin((col_of(day) + coef.w_shift) / coef.period_days * 2.0 * math.pi)
    return clip(raw, 0.0, 100.0)


def poi_density(count, diversity, coef: Coefficients = DEFAULT_COEF) -> Column:
    raw = F.log1p(col_of(count)) * coef.poi_count + col_of(diversity) * coef.poi_diversity
    return clip(raw, 0.0, 100.0)


def demand_score(intent, event, weather, poi, coef: Coefficients = DEFAULT_COEF) -> Column:
    return (
        coef.w_intent * col_of(intent)
        + coef.w_event * col_of(event)
        + coef.w_weather * col_of(weather)
        + coef.w_poi * col_of(poi)
    )


def organic_bookings(base, seasonality, weekend, holiday, coef: Coefficients = DEFAULT_COEF) -> Column:
    raw = col_of(base) * col_of(seasonality) * (1.0 + coef.org_weekend * col_of(weekend) + coef.org_holiday * col_of(holiday))
    return floor_zero(raw)


def campaign_uplift(treated, post, intent, weekend, coef: Coefficients = DEFAULT_COEF) -> Column:
    return (
        coef.uplift * col_of(treated) * col_of(post) * (col_of(intent) / coef.uplift_ref)
        * (1.0 + col_of(weekend) * coef.uplift_weekend)
    )


# -- scenario funnel and KPIs --------------------------------------------------

def scenario_spend(treatment, intent, event, coef: Coefficients = DEFAULT_COEF) -> Column:
    return F.when(
        col_of(treatment) == 1,
        coef.spend0 + coef.spend_intent * col_of(intent) + coef.spend_event * col_of(event),
    ).otherwise(F.lit(0.0))


def scenario_impressions(spend, coef: Coefficients = DEFAULT_COEF) -> Column:
    return floor_zero(col_of(spend) * coef.impressions_per_spend)


def scenario_clicks(impressions, intent, coef: Coefficients = DEFAULT_COEF) -> Column:
    return floor_zero(col_of(impressions) * (coef.ctr0 + col_of(intent) * coef.ctr_intent))


def scenario_incremental(treatment, intent, event, coef: Coefficients = DEFAULT_COEF) -> Column:
    return col_of(treatment) * (coef.inc0 + coef.inc_intent * col_of(intent) + coef.inc_event * col_of(event))


def scenario_order_value(intent, market, premium_market: str, coef: Coefficients = DEFAULT_COEF) -> Column:
    premium = (col_of(market) == F.lit(premium_market)).cast("double")
    return coef.aov0 + coef.aov_intent * col_of(intent) + premium * coef.aov_premium


def contribution_margin(gbv, raw_spend, coef: Coefficients = DEFAULT_COEF) -> Column:
    """margin = rate * GBV - spend, on the spend before any floor."""
    return col_of(gbv) * coef.margin_rate - col_of(raw_spend)


def conversion_rate(bookings, clicks) -> Column:
    return safe_ratio(bookings, clicks, 0.0)
