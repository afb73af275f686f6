"""Market rollups, calendars, balanced panels and the campaign panels.

A balanced panel is markets x study days. The calendar is generated per market row with
``explode(sequence(start, end))``, so the panel is built where the market rows already live:
no cross join, no shuffle, and the size is exactly markets x days by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftkit.config import (
    CONTROL_CAMPAIGN_ID,
    CONTROL_CHANNEL,
    DEFAULT_CATEGORY,
    DEFAULT_COEF,
    DEFAULT_DESIGN,
    DEFAULT_SEGMENT,
    TREATED_CAMPAIGN_ID,
    TREATED_CHANNEL,
    Coefficients,
    StudyDesign,
)
from liftkit.functions import signals as S
from liftkit.operators import quantiles


# -- listings -> sub-market rollup --------------------------------------------

def market_rollup(listings: DataFrame, design: StudyDesign = DEFAULT_DESIGN, median: str = "distributed") -> DataFrame:
    """Per (market, sub-market) listing statistics, keeping groups of ``min_listings`` or more.

    Missing keys drop out (as a pandas groupby does). The listings are read once, into a
    partial aggregate per (market, sub-market, price, room type); the statistics and the
    median are both finished from it, so the two consumers share one scan of the input.
    The median is exact: ``distributed`` (default) ranks distinct prices across range
    partitions, so a sub-market holding a third of all listings is still spread over many
    tasks; ``aggregate`` uses Spark's ``median`` (one value map per group, from the raw
    rows); ``approx`` uses ``percentile_approx``.
    """
    keys = ["neighbourhood_group", "neighbourhood"]
    present = listings.filter(F.col("neighbourhood_group").isNotNull() & F.col("neighbourhood").isNotNull())
    if median in ("aggregate", "approx"):
        med_agg = (F.median("price") if median == "aggregate" else F.percentile_approx("price", 0.5, 10000))
        med = present.groupBy(*keys).agg(med_agg.alias("median_price"))
    part = present.groupBy(*keys, "price", "room_type").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count("id").alias("_ids"),
        F.sum("reviews_per_month").alias("_rpm"),
        F.count("reviews_per_month").alias("_n_rpm"),
        F.sum("number_of_reviews").alias("_reviews"),
        F.sum("availability_365").alias("_avail"),
        F.count("availability_365").alias("_n_avail"),
    )
    priced = F.when(F.col("price").isNotNull(), F.col("_rows"))
    base = part.groupBy(*keys).agg(
        F.sum("_ids").alias("listing_count"),
        (F.sum(F.col("price") * F.col("_rows")) / F.sum(priced)).alias("avg_price"),
        (F.sum("_rpm") / F.sum("_n_rpm")).alias("review_velocity"),
        F.coalesce(F.sum("_reviews"), F.lit(0)).cast("long").alias("total_reviews"),
        (F.sum("_avail") / F.sum("_n_avail")).alias("avg_availability"),
        F.count_distinct("room_type").alias("room_diversity"),
    ).filter(F.col("listing_count") >= design.min_listings)
    if median == "distributed":
        med = quantiles.grouped_quantile(part, keys, "price", 0.5, "median_price", weight="_rows")
    base = base.join(med, keys, "left").withColumnRenamed("neighbourhood_group", "borough")
    base = base.select("borough", "neighbourhood", "listing_count", "avg_price", "median_price", "review_velocity",
                       "total_reviews", "avg_availability", "room_diversity")
    return base.withColumns(
        {
            "available_supply": F.col("listing_count") * (F.col("avg_availability") / 365.0),
            "estimated_lodging_revenue_proxy": F.col("avg_price") * F.col("listing_count")
            * (1 - F.col("avg_availability") / 365.0),
            "experience_category": S.first_match("borough", design.categories, DEFAULT_CATEGORY),
        }
    )


# -- calendar ------------------------------------------------------------------

def with_study_days(df: DataFrame, design: StudyDesign = DEFAULT_DESIGN) -> DataFrame:
    """Attach every study day to every row (balanced panel), with calendar features."""
    days = F.sequence(F.lit(design.start), F.lit(design.end))
    return with_calendar(df.withColumn("date", F.explode(days)), design)


def calendar_columns(d: Column, design: StudyDesign = DEFAULT_DESIGN) -> dict:
    """Calendar features of a date column, as composed expressions (one projection)."""
    day_index = F.datediff(d, F.lit(design.start))
    return {
        "day_index": day_index,
        "weekday": F.weekday(d),
        "weekend": S.weekend_flag(d),
        "holiday": S.holiday_flag(d, design.holidays),
        "date_iso": F.date_format(d, "yyyy-MM-dd"),
        "season": S.season(day_index),
    }


def with_calendar(df: DataFrame, design: StudyDesign = DEFAULT_DESIGN, date_col: str = "date") -> DataFrame:
    return df.withColumns(calendar_columns(F.col(date_col), design))


def assignment_columns(market: Column, day_index: Column, design: StudyDesign = DEFAULT_DESIGN) -> dict:
    """Treated market, post period, treatment / holdout flags, campaign id and channel."""
    treated = market.isin(list(design.treated)).cast("int")
    post = (day_index >= design.cutoff_day).cast("int")
    treatment = ((treated == 1) & (post == 1)).cast("int")
    return {
        "treated_market": treated,
        "post_period": post,
        "treatment_flag": treatment,
        "holdout_flag": 1 - treatment,
        "campaign_id": F.when(treatment == 1, F.lit(TREATED_CAMPAIGN_ID)).otherwise(F.lit(CONTROL_CAMPAIGN_ID)),
        "channel": F.when(treatment == 1, F.lit(TREATED_CHANNEL)).otherwise(F.lit(CONTROL_CHANNEL)),
    }


def with_assignment(df: DataFrame, design: StudyDesign = DEFAULT_DESIGN, market_col: str = "borough") -> DataFrame:
    """Treated market, post period, treatment / holdout flags, campaign id and channel."""
    return df.withColumns(assignment_columns(F.col(market_col), F.col("day_index"), design))


def segment_of(market: Column | str, design: StudyDesign = DEFAULT_DESIGN) -> Column:
    return S.lookup(market, design.segments, DEFAULT_SEGMENT)


# -- neighbourhood x day demand panel -------------------------------------------

DEMAND_PANEL_COLUMNS = [
    "date", "day_index", "borough", "neighbourhood", "traveler_segment", "experience_category",
    "listing_count", "available_supply", "avg_price", "review_velocity", "event_pressure",
    "intent_index", "weather_favorability", "poi_density", "weekend", "holiday", "treated_market",
    "post_period", "demand_signal_score", "experience_bookings_proxy",
]


def demand_panel(rollup: DataFrame, design: StudyDesign = DEFAULT_DESIGN, coef: Coefficients = DEFAULT_COEF,
                 keep_intermediate: bool = False) -> DataFrame:
    """Sub-market x day panel of demand signals (zero-noise form of the published formulas)."""
    p = with_assignment(with_study_days(rollup, design), design)
    p = p.withColumns(
        {
            "traveler_segment": segment_of("borough", design),
            "base_demand": S.base_demand("listing_count", "review_velocity", coef),
        }
    )
    p = p.withColumns(
        {
            "event_pressure": S.event_pressure("weekend", "holiday", "room_diversity", coef),
            "intent_index": S.intent_index("base_demand", "weekend", "holiday", coef),
            "weather_favorability": S.weather_favorability("day_index", coef),
            "poi_density": S.poi_density("listing_count", "room_diversity", coef),
            "organic_bookings": S.organic_bookings("base_demand", "season", "weekend", "holiday", coef),
        }
    )
    p = p.withColumns(
        {
            "campaign_effect": S.campaign_uplift("treated_market", "post_period", "intent_index", "weekend", coef),
            "demand_signal_score": S.demand_score("intent_index", "event_pressure", "weather_favorability", "poi_density", coef),
        }
    )
    p = p.withColumn("experience_bookings_proxy", F.col("organic_bookings") * (1 + F.col("campaign_effect")))
    typed = p.withColumns(
        {
            "listing_count": F.col("listing_count").cast("long"),
            "day_index": F.col("day_index").cast("int"),
        }
    )
    if keep_intermediate:
        return typed
    return typed.select(*DEMAND_PANEL_COLUMNS)


# -- market x day rollup and the scenario campaign panel ----------------------------

def market_day_rollup(panel: DataFrame) -> DataFrame:
    """Sub-market panel -> market x day: signal means, supply and baseline sums."""
    keys = ["date", "day_index", "borough", "traveler_segment", "treated_market", "post_period"]
    return panel.groupBy(*keys).agg(
        F.avg("demand_signal_score").alias("demand_signal_score"),
        F.avg("event_pressure").alias("event_pressure"),
        F.avg("intent_index").alias("intent_index"),
        F.avg("weather_favorability").alias("weather_favorability"),
        F.coalesce(F.sum("available_supply"), F.lit(0.0)).alias("available_supply"),
        F.avg("review_velocity").alias("review_velocity"),
        F.coalesce(F.sum("experience_bookings_proxy"), F.lit(0.0)).alias("baseline_experience_bookings"),
    )


MARKETING_PANEL_COLUMNS = [
    "date", "day_index", "borough", "traveler_segment", "treated_market", "treatment_flag",
    "holdout_flag", "post_period", "campaign_id", "channel", "spend", "impressions", "clicks",
    "experience_bookings", "gbv", "contribution_margin", "conversion_rate", "demand_signal_score",
    "event_pressure", "intent_index", "weather_favorability", "available_supply",
]


def scenario_panel(daily: DataFrame, design: StudyDesign = DEFAULT_DESIGN, coef: Coefficients = DEFAULT_COEF) -> DataFrame:
    """Market-day rollup -> campaign panel with the scenario funnel and response (zero noise)."""
    treatment = ((F.col("treated_market") == 1) & (F.col("post_period") == 1)).cast("int")
    p = daily.withColumn("treatment_flag", treatment)
    p = p.withColumn("raw_spend", S.scenario_spend("treatment_flag", "intent_index", "event_pressure", coef))
    p = p.withColumn("impressions", S.scenario_impressions("raw_spend", coef))
    p = p.withColumn("clicks", S.scenario_clicks("impressions", "intent_index", coef))
    p = p.withColumn(
        "experience_bookings",
        S.floor_zero(F.col("baseline_experience_bookings")
                     + S.scenario_incremental("treatment_flag", "intent_index", "event_pressure", coef)),
    )
    p = p.withColumn("gbv", F.col("experience_bookings")
                     * S.scenario_order_value("intent_index", "borough", design.premium_market, coef))
    return _finish_marketing(p, coef)


MARKETING_DOUBLES = {"spend", "impressions", "clicks", "experience_bookings", "gbv", "contribution_margin",
                     "conversion_rate", "demand_signal_score", "event_pressure", "intent_index",
                     "weather_favorability", "available_supply"}


def _marketing_select(p: DataFrame, exprs: dict) -> DataFrame:
    """Project the campaign-panel columns from ``exprs`` (name -> Column; missing names are
    taken from ``p``) in one projection, with the published types."""
    out = []
    for c in MARKETING_PANEL_COLUMNS:
        e = exprs.get(c, F.col(c))
        out.append((e.cast("double") if c in MARKETING_DOUBLES else e.cast("int") if c == "day_index" else e).alias(c))
    return p.select(*out)


def _finish_marketing(p: DataFrame, coef: Coefficients) -> DataFrame:
    treatment = F.col("treatment_flag")
    return _marketing_select(p, {
        "contribution_margin": S.contribution_margin("gbv", "raw_spend", coef),
        "conversion_rate": S.conversion_rate("experience_bookings", "clicks"),
        "spend": S.floor_zero("raw_spend"),
        "holdout_flag": 1 - treatment,
        "campaign_id": F.when(treatment == 1, F.lit(TREATED_CAMPAIGN_ID)).otherwise(F.lit(CONTROL_CAMPAIGN_ID)),
        "channel": F.when(treatment == 1, F.lit(TREATED_CHANNEL)).otherwise(F.lit(CONTROL_CHANNEL)),
    })


# -- observed campaign panel from funnel facts ---------------------------------------

def panel_scaffold(markets: DataFrame, design: StudyDesign = DEFAULT_DESIGN) -> DataFrame:
    """Every market x every study day, with calendar and assignment columns."""
    m = markets.select("borough").filter(F.col("borough").isNotNull()).distinct()
    dated = m.withColumn("date", F.explode(F.sequence(F.lit(design.start), F.lit(design.end))))
    cal = calendar_columns(F.col("date"), design)
    return dated.withColumns({**cal, **assignment_columns(F.col("borough"), cal["day_index"], design)})


def attach_facts(scaffold: DataFrame, facts: DataFrame, measures: list[str]) -> DataFrame:
    """Left join facts on (market, date); a missing cell is zero activity."""
    f = facts.select("borough", "date", *measures)
    joined = scaffold.join(f, ["borough", "date"], "left")
    keep = [f"`{c}`" for c in joined.columns if c not in measures]
    return joined.selectExpr(*keep, *[f"coalesce(`{m}`, 0.0D) AS `{m}`" for m in measures])


FACT_MEASURES = ["impressions", "clicks", "bookings", "gbv", "click_cost", "signals_event", "activity",
                 "active_units", "diversity"]


def observed_panel(markets: DataFrame, facts: DataFrame, design: StudyDesign = DEFAULT_DESIGN,
                   coef: Coefficients = DEFAULT_COEF) -> DataFrame:
    """Balanced market x day campaign panel from observed funnel facts.

    spend = click cost in treated-post cells, else 0; intent = 100 x (impressions + clicks) /
    activity; event pressure = event signal count; supply = active units; weather and place
    density from the calendar / activity formulas; KPIs as in the scenario panel. All derived
    columns are composed into one projection over the scaffold-facts join.
    """
    p = attach_facts(panel_scaffold(markets, design), facts, FACT_MEASURES)
    c = F.col
    raw_spend = F.when(c("treatment_flag") == 1, c("click_cost")).otherwise(F.lit(0.0))
    intent = S.safe_ratio((c("impressions") + c("clicks")) * 100.0, c("activity"), 0.0)
    weather = S.weather_favorability("day_index", coef)
    poi = S.poi_density("active_units", "diversity", coef)
    event = c("signals_event")
    return _marketing_select(p, {
        "traveler_segment": segment_of("borough", design),
        "spend": S.floor_zero(raw_spend),
        "experience_bookings": c("bookings"),
        "contribution_margin": S.contribution_margin("gbv", raw_spend, coef),
        "conversion_rate": S.conversion_rate("bookings", "clicks"),
        "demand_signal_score": S.demand_score(intent, event, weather, poi, coef),
        "event_pressure": event,
        "intent_index": intent,
        "weather_favorability": weather,
        "available_supply": c("active_units"),
    })
