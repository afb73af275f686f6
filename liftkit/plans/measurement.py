"""The end-to-end measurement chain as one lazy graph of DataFrames.

listings -> clean -> outlier filter -> sub-market rollup -> demand panel;
funnel facts -> balanced market-day campaign panel -> difference-in-differences ->
opportunity scores -> decision metrics. Writing the warehouse is the only action.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftkit.config import DEFAULT_COEF, Coefficients, StudyDesign
from liftkit.operators import causal, cleaning, ml, panel, scoring, trees
from liftkit.operators import metrics as metrics_
from liftkit.plans import reports
from liftkit.session import ensure_checkpoint_dir
from liftkit.sources import tables as T


@dataclass
class MeasurementRun:
    listings: DataFrame
    demand_panel: DataFrame
    marketing: DataFrame
    metrics: DataFrame
    scores: DataFrame
    decision_metrics: DataFrame

    def warehouse(self) -> dict[str, DataFrame]:
        return {
            "neighborhood_demand_panel": self.demand_panel,
            "marketing_experiment_panel": self.marketing,
            "experience_opportunity_scores": self.scores,
            "decision_metrics": self.decision_metrics,
        }

    def register_views(self) -> None:
        reports.register_views(self.warehouse())


def run(listings_raw: DataFrame, markets: DataFrame, facts: DataFrame, design: StudyDesign,
        coef: Coefficients = DEFAULT_COEF, predicted: DataFrame | None = None, r2: float | None = None,
        materialize: str | None = None, fit_forest: bool = False) -> MeasurementRun:
    """Build every output lazily.

    The market-day panel feeds the estimate, the scores, the decision table and the reports.
    ``materialize="checkpoint"`` writes it once to the shared ``spark.checkpoint.dir``
    (lineage cut; a lost executor re-reads it instead of recomputing the fact joins);
    ``"cache"`` keeps it in executor memory and disk. ``fit_forest`` fits the demand forest on
    the panel and scores with its predictions; without it (and without ``predicted``) the mean
    bookings stand in.
    """
    listings = cleaning.outlier_filter(cleaning.clean_listings(listings_raw))
    demand = panel.demand_panel(panel.market_rollup(listings, design), design, coef)
    marketing = panel.observed_panel(markets, facts, design, coef)
    if materialize == "checkpoint":
        ensure_checkpoint_dir(marketing.sparkSession)
        marketing = marketing.checkpoint(eager=True)
    elif materialize == "cache":
        marketing = marketing.persist(StorageLevel.MEMORY_AND_DISK)
    if fit_forest:
        predicted, r2 = fit_demand_model(marketing)
    metrics = causal.did_estimate(marketing)
    scores = scoring.opportunity_scores(marketing, predicted, r2, coef)
    dm = causal.decision_metrics(listings, demand, marketing)
    return MeasurementRun(listings, demand, marketing, metrics, scores, dm)


def demand_rows(marketing: DataFrame, seed: int = 42, test_fraction: float = 0.25) -> DataFrame:
    """The campaign panel as the forest reads it: key (market and date), label, signals, split."""
    keyed = marketing.withColumn("_key", F.concat_ws("|", "borough", F.col("date").cast("string")))
    return ml.split_hash(keyed, "_key", test_fraction, seed).select(
        "_key", F.col("experience_bookings").alias("label"), "split",
        F.array(*[F.col(c).cast("double") for c in scoring.SIGNALS]).alias("features"))


def fit_demand_model(marketing: DataFrame, n_trees: int = 100, min_leaf: int = 4, seed: int = 42,
                     test_fraction: float = 0.25, max_depth: int = 8) -> tuple[DataFrame, float | None]:
    """The forest on the campaign panel: predicted mean bookings per market, and the R^2 on the
    rows held out (a hash of market and date). Trees split exactly, every signal is looked at in
    every node, and bootstraps are a hash of (tree, key), so a fit can be repeated anywhere;
    ``max_depth`` bounds the model. The panel is read once per level, so give a checkpointed one."""
    rows = demand_rows(marketing, seed, test_fraction).persist(StorageLevel.MEMORY_AND_DISK)
    model = trees.grow(rows.filter("split = 'train'"), scoring.SIGNALS, trees.bootstrap_weights("_key", n_trees, seed), n_trees,
                       max_depth=max_depth, min_leaf=min_leaf, seed=seed)
    r2 = metrics_.r2_score(model.predict(rows.filter("split = 'test'"))).first()["r2"]
    rows.unpersist()
    feats = scoring.market_features(marketing).select(
        "borough", F.array(*[F.col(c).cast("double") for c in scoring.SIGNALS]).alias("features"))
    return model.predict(feats, out="predicted_daily_experience_bookings").drop("features"), r2


def run_test_tables(spark: SparkSession, sf_dir: str, **kw) -> MeasurementRun:
    """The chain over the star-schema test tables (events funnel)."""
    return run(T.listings(spark, sf_dir), T.markets(spark, sf_dir), T.event_funnel_facts(spark, sf_dir),
               T.TEST_DESIGN, **kw)
