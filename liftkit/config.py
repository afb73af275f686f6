"""Study constants.

Every operator takes its coefficients as arguments; the defaults below are the values the
measurement method was published with. ``StudyDesign`` groups the experiment window and
assignment, ``Coefficients`` the signal and response formulas.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the published method for identical results)
# ---------------------------------------------------------------------------
# Market -> traveller segment; unknown markets fall back to DEFAULT_SEGMENT.
MARKET_SEGMENTS = {
    "Manhattan": "culture_seekers",
    "Brooklyn": "local_creatives",
    "Queens": "value_explorers",
    "Bronx": "family_discovery",
    "Staten Island": "outdoor_daytrip",
}
DEFAULT_SEGMENT = "general_travelers"

# Market -> experience category, first match wins; others get DEFAULT_CATEGORY.
MARKET_CATEGORIES = [
    ("Manhattan", "culture_food_nightlife"),
    ("Brooklyn", "local_creative_food"),
    ("Queens", "multicultural_food"),
    ("Bronx", "family_culture"),
]
DEFAULT_CATEGORY = "outdoor_daytrip"

TREATED_MARKETS = ("Brooklyn", "Queens")
POST_START_DAY = 46
PANEL_START = dt.date(2026, 5, 1)
PANEL_DAYS = 90
HOLIDAYS_MM_DD = ("05-25", "07-04")
PREMIUM_MARKET = "Manhattan"

TREATED_CAMPAIGN_ID = "EXP_NYC_SUMMER_2026"
CONTROL_CAMPAIGN_ID = "HOLDOUT_OR_PRE"
TREATED_CHANNEL = "paid_social_search"
CONTROL_CHANNEL = "none"

ACTION_SCALE = "scale with geo holdout"
ACTION_TEST = "test with smaller budget"
ACTION_HOLD = "hold / improve signal quality"
DECISION_SCALE = "scale with geo holdouts"
DECISION_RETEST = "retest before scaling"

# Decision-metric rows in output order. The metric names. What follows each
# name says what the code here computes.
DECISION_METRIC_TEXT = [
    ("source_listing_rows", "listings left after parsing and the price bound"),
    ("neighborhood_day_rows", "rows of the sub-market by day table"),
    ("marketing_market_day_rows", "rows of the market by day panel behind the estimate"),
    ("estimated_incremental_bookings", "bookings: treated change minus control change, times treated post-period rows"),
    ("estimated_incremental_gbv", "booking value: treated change minus control change, times treated post-period rows"),
    ("estimated_incremental_margin", "margin: treated change minus control change, times treated post-period rows"),
    ("incremental_roas", "extra booking value for each unit of treated post-period spend"),
    ("cost_per_incremental_booking", "treated post-period spend for each extra booking"),
    ("pretrend_slope_gap_bookings_per_day", "treated minus control slope of bookings over the days before the start"),
]

# Default evidence criteria for a text corpus: (criterion, points, signals to find). Any table
# of this shape can be passed instead.
RUBRIC = [
    ("States its terms of use", 10, ["license", "version", "released under"]),
    ("Names a permissive licence", 10, ["mit license", "apache license"]),
    ("Names a restrictive licence", 10, ["gnu general public", "by-nc"]),
    ("Has English prose", 10, ["the ", " and ", " of "]),
    ("Has French prose", 10, [" le ", " que ", " pour "]),
    ("Has German prose", 10, [" der ", " und ", " nicht "]),
    ("Has Spanish prose", 10, [" el ", " para ", " los "]),
    ("Holds contact data", 10, ["@", "+", "www."]),
    ("Holds tabular text", 10, [" | "]),
    ("Holds markup noise", 10, ["%%%", "###", "$$$", "&&&"]),
]
PASS_SCORE = 85
REQUIRED_TABLES = (
    "neighborhood_demand_panel",
    "marketing_experiment_panel",
    "experience_opportunity_scores",
    "decision_metrics",
)
# Panel columns that no input observes: they are functions of the date alone.
DATE_DERIVED_FIELDS = ["weather_favorability"]


@dataclass(frozen=True)
class StudyDesign:
    """Experiment window and assignment. The defaults are fixed values."""

    start: dt.date = PANEL_START
    days: int = PANEL_DAYS
    cutoff_day: int = POST_START_DAY
    treated: tuple[str, ...] = TREATED_MARKETS
    holidays: tuple[str, ...] = HOLIDAYS_MM_DD
    premium_market: str = PREMIUM_MARKET
    segments: dict = field(default_factory=lambda: dict(MARKET_SEGMENTS))
    categories: tuple = tuple(MARKET_CATEGORIES)
    min_listings: int = 20

    @property
    def end(self) -> dt.date:
        return self.start + dt.timedelta(days=self.days - 1)


@dataclass(frozen=True)
class Coefficients:
    """Signal, response and KPI coefficients. Fixed values of the published method."""

    season_amp: float = 0.15
    period_days: float = 90.0
    # event pressure = ep0 + ep_weekend*weekend + ep_holiday*holiday + diversity
    ep0: float = 8.0
    ep_weekend: float = 5.0
    ep_holiday: float = 9.0
    # intent = in0 + in_base*base + in_weekend*weekend + in_holiday*holiday, clipped
    in0: float = 45.0
    in_base: float = 1.8
    in_weekend: float = 6.0
    in_holiday: float = 10.0
    in_lo: float = 1.0
    in_hi: float = 100.0
    # weather = w0 + w_amp*sin(2*pi*(day + w_shift)/period), clipped
    w0: float = 65.0
    w_amp: float = 18.0
    w_shift: float = 10.0
    # poi = poi_count*log1p(count) + poi_diversity*diversity, clipped
    poi_count: float = 9.0
    poi_diversity: float = 5.0
    # base demand = base_count*log1p(count) + base_velocity*velocity
    base_count: float = 3.0
    base_velocity: float = 8.0
    # demand score weights (the published form writes 0.25 * event * 5)
    w_intent: float = 0.35
    w_event: float = 1.25
    w_weather: float = 0.20
    w_poi: float = 0.20
    # organic multipliers
    org_weekend: float = 0.12
    org_holiday: float = 0.18
    # campaign uplift = uplift * treated * post * (intent / uplift_ref) * (1 + uplift_weekend*weekend)
    uplift: float = 0.10
    uplift_ref: float = 70.0
    uplift_weekend: float = 0.15
    # scenario funnel
    spend0: float = 1800.0
    spend_intent: float = 14.0
    spend_event: float = 28.0
    impressions_per_spend: float = 42.0
    ctr0: float = 0.018
    ctr_intent: float = 1.0 / 10000.0
    inc0: float = 4.5
    inc_intent: float = 0.055
    inc_event: float = 0.35
    aov0: float = 92.0
    aov_intent: float = 0.55
    aov_premium: float = 18.0
    margin_rate: float = 0.22
    # opportunity score weights
    s_demand: float = 0.45
    s_event: float = 0.25
    s_supply: float = 0.20
    s_predicted: float = 0.10
    action_score: float = 65.0
    max_pretrend_gap: float = 1.5


DEFAULT_DESIGN = StudyDesign()
DEFAULT_COEF = Coefficients()
