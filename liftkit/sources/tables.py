"""Adapters from the star-schema test tables onto the measurement data model.

| Concept            | Test tables                                                     |
|--------------------|-----------------------------------------------------------------|
| listing row        | customer + nation + region, left join per-customer order stats  |
| market / sub-market| region name / nation name                                       |
| market-day funnel  | events (view / click / purchase / signup) by user's region      |
| larger funnel      | lineitem + orders by customer's region and ship date            |

Dimension joins (nation, region) are left to the planner: they are a few rows, so the
size-based broadcast threshold picks a broadcast hash join without a hint. Fact tables are
pre-aggregated on their own keys before any join, so a user or customer that owns a third
of all rows is reduced map-side before the shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftkit.config import StudyDesign

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed values for the test-data study (our mapping of the star schema; not published ones).
TEST_DESIGN = StudyDesign(
    start=dt.date(2024, 1, 1),
    days=30,
    cutoff_day=15,
    treated=("ASIA", "EUROPE"),
    holidays=("01-01", "01-15"),
    premium_market="EUROPE",
    segments={
        "AFRICA": "outdoor_daytrip",
        "AMERICA": "value_explorers",
        "ASIA": "culture_seekers",
        "EUROPE": "local_creatives",
    },
    categories=(
        ("AMERICA", "multicultural_food"),
        ("ASIA", "culture_food_nightlife"),
        ("EUROPE", "local_creative_food"),
    ),
    min_listings=20,
)
# Order-history reference point and month span for the listing adapter.
LISTING_AS_OF = "2001-08-01"
LISTING_MONTHS = 80.0
# Lineitem funnel study: ship dates 1995-2001, campaign from 1998-07-01 in the same markets.
LINEITEM_DESIGN = StudyDesign(
    start=dt.date(1995, 1, 1),
    days=(dt.date(2001, 12, 31) - dt.date(1995, 1, 1)).days + 1,
    cutoff_day=(dt.date(1998, 7, 1) - dt.date(1995, 1, 1)).days,
    treated=TEST_DESIGN.treated,
    holidays=TEST_DESIGN.holidays,
    premium_market=TEST_DESIGN.premium_market,
    segments=TEST_DESIGN.segments,
    categories=TEST_DESIGN.categories,
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet relation of a test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def in_window(df: DataFrame, col: str, design: StudyDesign) -> DataFrame:
    """Rows whose raw date or timestamp lies in the study window. The bounds are constants of
    the column's own type, so they reach the scan."""
    kind = df.schema[col].dataType
    first, after = (F.lit(d.isoformat()).cast(kind) for d in (design.start, design.end + dt.timedelta(days=1)))
    return df.filter((F.col(col) >= first) & (F.col(col) < after))


def customer_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """c_custkey -> (borough = region name, neighbourhood = nation name)."""
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("r_name").alias("borough"), F.col("n_name").alias("neighbourhood")
    )
    return customer.join(geo, customer.c_nationkey == geo.n_nationkey).select("c_custkey", "borough", "neighbourhood")


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every market (region) name: the rows of the balanced panel."""
    return read_table(spark, sf_dir, "region").select(F.col("r_name").alias("borough"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listing rows with the text columns a CSV export would carry.

    price = account balance as money text ('$1,234.50'); reviews = order count; last review =
    last order date; reviews per month = orders / 80 (NULL without orders); availability =
    days from the last order to 2001-08-01 capped at 365 (NULL without orders).
    """
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    order_stats = (
        read_table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_order"))
    )
    days_since = F.datediff(F.lit(LISTING_AS_OF).cast("date"), F.to_date("last_order"))
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .join(order_stats, customer.c_custkey == order_stats.o_custkey, "left")
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_nationkey").cast("long").alias("host_id"),
            F.concat(F.lit("host "), F.col("c_nationkey").cast("string")).alias("host_name"),
            F.col("r_name").alias("neighbourhood_group"),
            F.col("n_name").alias("neighbourhood"),
            F.col("c_mktsegment").alias("room_type"),
            F.concat(F.lit("$"), F.format_number("c_acctbal", 2)).alias("price"),
            F.coalesce(F.col("n_orders"), F.lit(0)).cast("long").alias("number_of_reviews"),
            F.date_format("last_order", "yyyy-MM-dd").alias("last_review"),
            (F.col("n_orders") / F.lit(LISTING_MONTHS)).cast("string").alias("reviews_per_month"),
            F.least(days_since, F.lit(365)).cast("string").alias("availability_365"),
        )
    )


KINDS = {"view": "views", "click": "clicks", "purchase": "purchases", "signup": "signups"}


def event_user_day(spark: SparkSession, sf_dir: str, design: StudyDesign = TEST_DESIGN) -> DataFrame:
    """First aggregation level: one row per (user, day) with counts and values by event type and
    the set of types. A partial aggregate, so a hot user is collapsed map-side."""
    events = in_window(read_table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value"), "ts", design)
    kind = F.col("event_type")
    return events.groupBy("user_id", F.to_date("ts").alias("date")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(kind == k, 1)).alias(name) for k, name in KINDS.items()],
        F.sum(F.when(kind == "purchase", F.col("value"))).alias("purchase_value"),
        F.sum(F.when(kind == "click", F.col("value"))).alias("click_value"),
        F.collect_set("event_type").alias("kinds"),
    )


def event_funnel_facts(spark: SparkSession, sf_dir: str, design: StudyDesign = TEST_DESIGN) -> DataFrame:
    """Observed funnel per (borough, date) from the events table: per (user, day) first, then,
    with the user's market attached, per market-day. Each user-day is one row, so active users
    are a plain count; the types of a day are a union of small sets."""
    cm = customer_markets(spark, sf_dir).select("c_custkey", "borough")
    per = event_user_day(spark, sf_dir, design)
    joined = per.join(cm, per.user_id == cm.c_custkey)
    return joined.groupBy("borough", "date").agg(
        F.sum("views").cast("double").alias("impressions"),
        F.sum("clicks").cast("double").alias("clicks"),
        F.sum("purchases").cast("double").alias("bookings"),
        F.coalesce(F.sum("purchase_value"), F.lit(0.0)).alias("gbv"),
        F.coalesce(F.sum("click_value"), F.lit(0.0)).alias("click_cost"),
        F.sum("signups").cast("double").alias("signals_event"),
        F.sum("n").cast("double").alias("activity"),
        F.count(F.lit(1)).cast("double").alias("active_units"),
        F.size(F.array_distinct(F.flatten(F.collect_set("kinds")))).cast("double").alias("diversity"),
    )


def unknown_user_events(spark: SparkSession, sf_dir: str, design: StudyDesign = TEST_DESIGN) -> DataFrame:
    """How many events in the window belong to no known user, and so to no market: the rows
    that ``event_funnel_facts`` cannot place."""
    cm = customer_markets(spark, sf_dir).select("c_custkey")
    per = event_user_day(spark, sf_dir, design)
    return per.join(cm, per.user_id == cm.c_custkey, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_events"))


def lineitem_funnel_facts(spark: SparkSession, sf_dir: str, design: StudyDesign = LINEITEM_DESIGN) -> DataFrame:
    """Larger funnel per (borough, ship date) from lineitem + orders + customer.

    impressions = quantity; clicks = lines; bookings = lines not returned; GBV = net price;
    click cost = tax amount; event signal = lines with discount >= 0.05; activity = lines.
    """
    li = in_window(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate"), "l_shipdate", design)
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    per = li.groupBy("l_orderkey", F.to_date("l_shipdate").alias("date")).agg(
        F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("lines"),
        F.count(F.when(F.col("l_returnflag") != "R", 1)).alias("sold"), F.sum(net).alias("net"),
        F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias("tax"),
        F.count(F.when(F.col("l_discount") >= 0.05, 1)).alias("discounted"), F.collect_set("l_returnflag").alias("flags"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cm = customer_markets(spark, sf_dir).select("c_custkey", "borough")
    order_market = orders.join(cm, orders.o_custkey == cm.c_custkey).select("o_orderkey", "borough")
    joined = per.join(order_market, per.l_orderkey == order_market.o_orderkey)
    return joined.groupBy("borough", "date").agg(
        F.sum("quantity").alias("impressions"),
        F.sum("lines").cast("double").alias("clicks"),
        F.sum("sold").cast("double").alias("bookings"),
        F.sum("net").alias("gbv"),
        F.sum("tax").alias("click_cost"),
        F.sum("discounted").cast("double").alias("signals_event"),
        F.sum("lines").cast("double").alias("activity"),
        F.count(F.lit(1)).cast("double").alias("active_units"),
        F.size(F.array_distinct(F.flatten(F.collect_set("flags")))).cast("double").alias("diversity"),
    )
