"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame`` over the test tables.

Each query is the library operator applied to the test-table adapters, followed by
``stable`` (doubles rounded to ten significant digits) so results compare across engines.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from liftkit.functions import clean as clean_fn
from liftkit.operators import causal, cleaning, logistic, metrics, ml, panel, profile, quality, scoring, trees
from liftkit.plans import measurement, reports
from liftkit.sources import files
from liftkit.sources import tables as T
from liftkit.sources.tables import TEST_DESIGN

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def stable(df: DataFrame) -> DataFrame:
    """Round every double output to ten significant digits (as the SQL oracle does), so
    last-bit differences from summation order compare equal across engines; magnitudes
    below 1e-12 (cancellation noise around zero) become 0. One SQL projection."""
    exprs = []
    for f in df.schema.fields:
        q = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, (DoubleType, FloatType)):
            exprs.append(f"CASE WHEN {q} IS NULL THEN NULL WHEN abs({q}) < 1e-12 THEN 0.0D ELSE CAST(format_string('%.9e', CAST({q} AS DOUBLE)) AS DOUBLE) END AS {q}")
        else:
            exprs.append(q)
    return df.selectExpr(*exprs)


# -- building blocks over the test tables ------------------------------------------

def observed_marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market x day campaign panel from the events funnel (the minimum slice)."""
    return panel.observed_panel(T.markets(spark, sf_dir), T.event_funnel_facts(spark, sf_dir), TEST_DESIGN)


# -- minimum slice -----------------------------------------------------------------------

@register("panel_facts")
def q_panel_facts(spark, sf_dir):
    return stable(observed_marketing(spark, sf_dir))


@register("did_estimate")
def q_did_estimate(spark, sf_dir):
    return stable(causal.did_estimate(observed_marketing(spark, sf_dir)))


def lineitem_marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market x ship-day campaign panel from lineitem + orders (the larger funnel)."""
    return panel.observed_panel(T.markets(spark, sf_dir), T.lineitem_funnel_facts(spark, sf_dir), T.LINEITEM_DESIGN)


@register("lineitem_did")
def q_lineitem_did(spark, sf_dir):
    return stable(causal.did_estimate(lineitem_marketing(spark, sf_dir)))


# -- listings chain ------------------------------------------------------------------------

def raw_listings(spark, sf_dir):
    return T.listings(spark, sf_dir)


def cleaned_listings(spark, sf_dir):
    return cleaning.clean_listings(T.listings(spark, sf_dir))


def filtered_listings(spark, sf_dir):
    return cleaning.outlier_filter(cleaned_listings(spark, sf_dir))


def rollup(spark, sf_dir):
    return panel.market_rollup(filtered_listings(spark, sf_dir), TEST_DESIGN)


def demand(spark, sf_dir, keep_intermediate=False):
    return panel.demand_panel(rollup(spark, sf_dir), TEST_DESIGN, keep_intermediate=keep_intermediate)


def market_days(spark, sf_dir):
    return panel.market_day_rollup(demand(spark, sf_dir))


def scenario(spark, sf_dir):
    return panel.scenario_panel(market_days(spark, sf_dir), TEST_DESIGN)


RAW_COLS = ["id", "name", "host_id", "host_name", "neighbourhood_group", "neighbourhood", "room_type", "price",
            "number_of_reviews", "last_review", "reviews_per_month", "availability_365"]


@register("clean_price")
def q_clean_price(spark, sf_dir):
    raw = raw_listings(spark, sf_dir)
    return stable(raw.select("id", F.col("price").alias("price_text"), clean_fn.clean_price("price").alias("price")))


@register("safe_dates")
def q_safe_dates(spark, sf_dir):
    return raw_listings(spark, sf_dir).select("id", clean_fn.safe_date("last_review").alias("last_review"))


@register("clean_listings")
def q_clean_listings(spark, sf_dir):
    return stable(cleaned_listings(spark, sf_dir).select(*RAW_COLS))


@register("outlier_filter")
def q_outlier_filter(spark, sf_dir):
    return stable(filtered_listings(spark, sf_dir).select(*RAW_COLS))


@register("drop_zero")
def q_drop_zero(spark, sf_dir):
    return stable(cleaning.drop_zero(cleaned_listings(spark, sf_dir)).select("id", "price"))


@register("binarize")
def q_binarize(spark, sf_dir):
    return cleaning.binarize(cleaned_listings(spark, sf_dir), "availability_365", 165).select("id", "availability_365")


@register("profile_select")
def q_profile_select(spark, sf_dir):
    df = profile.profile_select(cleaned_listings(spark, sf_dir), drop=["id", "name", "host_id", "host_name"])
    return stable(profile.profile_select(df, drop=["last_review"]))


@register("category_share")
def q_category_share(spark, sf_dir):
    return stable(profile.category_share(cleaned_listings(spark, sf_dir), "room_type"))


@register("distinct_values")
def q_distinct_values(spark, sf_dir):
    return profile.distinct_values(raw_listings(spark, sf_dir))


@register("market_rollup")
def q_market_rollup(spark, sf_dir):
    return stable(rollup(spark, sf_dir))


@register("market_category")
def q_market_category(spark, sf_dir):
    return rollup(spark, sf_dir).select("borough", "neighbourhood", "experience_category")


@register("demand_panel")
def q_demand_panel(spark, sf_dir):
    return stable(demand(spark, sf_dir))


@register("demand_signals")
def q_demand_signals(spark, sf_dir):
    return stable(demand(spark, sf_dir, True).select(
        "date", "borough", "neighbourhood", "base_demand", "event_pressure", "intent_index",
        "weather_favorability", "poi_density"))


@register("demand_score")
def q_demand_score(spark, sf_dir):
    return stable(demand(spark, sf_dir).select("date", "neighbourhood", "demand_signal_score"))


@register("baseline_forecast")
def q_baseline_forecast(spark, sf_dir):
    return stable(demand(spark, sf_dir, True).select(
        "date", "neighbourhood", "season", "organic_bookings", "campaign_effect", "experience_bookings_proxy"))


@register("market_day_rollup")
def q_market_day_rollup(spark, sf_dir):
    return stable(market_days(spark, sf_dir))


@register("scenario_panel")
def q_scenario_panel(spark, sf_dir):
    return stable(scenario(spark, sf_dir))


@register("segment_lookup")
def q_segment_lookup(spark, sf_dir):
    cm = T.customer_markets(spark, sf_dir)
    return cm.select("c_custkey", "borough", panel.segment_of("borough", TEST_DESIGN).alias("traveler_segment"))


@register("calendar_features")
def q_calendar_features(spark, sf_dir):
    dates = T.read_table(spark, sf_dir, "events").select(F.to_date("ts").alias("date")).distinct()
    cal = panel.with_calendar(dates, TEST_DESIGN)
    return stable(cal.select("date", "day_index", "weekday", "weekend", "holiday", "date_iso", "season"))


@register("panel_scaffold")
def q_panel_scaffold(spark, sf_dir):
    return panel.panel_scaffold(T.markets(spark, sf_dir), TEST_DESIGN).select(
        "borough", "date", F.col("day_index").cast("int").alias("day_index"), "treated_market", "post_period")


@register("assignment_flags")
def q_assignment_flags(spark, sf_dir):
    return observed_marketing(spark, sf_dir).select(
        "borough", "date", "treated_market", "post_period", "treatment_flag", "holdout_flag", "campaign_id", "channel")


@register("kpi_panel")
def q_kpi_panel(spark, sf_dir):
    return stable(observed_marketing(spark, sf_dir).select(
        "borough", "date", "spend", "clicks", "experience_bookings", "gbv", "contribution_margin", "conversion_rate"))


# -- estimate, scores, decision --------------------------------------------------------------

@register("did_cells")
def q_did_cells(spark, sf_dir):
    return stable(causal.did_cells(observed_marketing(spark, sf_dir)))


@register("pretrend")
def q_pretrend(spark, sf_dir):
    return stable(causal.pretrend(observed_marketing(spark, sf_dir)))


@register("decision")
def q_decision(spark, sf_dir):
    m = causal.decision(causal.did_estimate(observed_marketing(spark, sf_dir)))
    return stable(m.select("estimated_incremental_margin", "pretrend_slope_gap_bookings_per_day", "decision"))


def measured_run(spark, sf_dir):
    return measurement.run_test_tables(spark, sf_dir)


@register("decision_metrics")
def q_decision_metrics(spark, sf_dir):
    return stable(measured_run(spark, sf_dir).decision_metrics)


@register("opportunity_features")
def q_opportunity_features(spark, sf_dir):
    return stable(scoring.market_features(observed_marketing(spark, sf_dir)))


@register("opportunity_scores")
def q_opportunity_scores(spark, sf_dir):
    return stable(scoring.opportunity_scores(observed_marketing(spark, sf_dir)))


@register("opportunity_scores_forest")
def q_opportunity_scores_forest(spark, sf_dir):
    """Scores whose demand term is the fitted forest's prediction, with its holdout R^2."""
    mp = observed_marketing(spark, sf_dir)
    predicted, r2 = measurement.fit_demand_model(mp)
    return stable(scoring.opportunity_scores(mp, predicted, r2))


@register("top_market")
def q_top_market(spark, sf_dir):
    return stable(scoring.top_market(scoring.opportunity_scores(observed_marketing(spark, sf_dir))))


@register("score_frame")
def q_score_frame(spark, sf_dir):
    return stable(reports.score_frame(scoring.opportunity_scores(observed_marketing(spark, sf_dir))))


@register("pct_rank_avg")
def q_pct_rank_avg(spark, sf_dir):
    names = {"avg_price_rank": "avg_price", "room_diversity_rank": "room_diversity", "total_reviews_rank": "total_reviews"}
    return stable(scoring.percentile_ranks(rollup(spark, sf_dir), names).select("borough", "neighbourhood", *names))


# -- reports over warehouse views ---------------------------------------------------------------

def _report(spark, sf_dir, name):
    measured_run(spark, sf_dir).register_views()
    return stable(reports.run_report(spark, name))


@register("report_best_markets")
def q_report_best_markets(spark, sf_dir):
    return _report(spark, sf_dir, "best_markets")


@register("report_lift")
def q_report_lift(spark, sf_dir):
    return _report(spark, sf_dir, "lift")


@register("report_signals")
def q_report_signals(spark, sf_dir):
    return _report(spark, sf_dir, "signals")


@register("report_metrics")
def q_report_metrics(spark, sf_dir):
    return _report(spark, sf_dir, "metrics")


@register("trend_frame")
def q_trend_frame(spark, sf_dir):
    return stable(reports.trend_frame(observed_marketing(spark, sf_dir)))


@register("signal_map_frame")
def q_signal_map_frame(spark, sf_dir):
    return stable(reports.signal_map_frame(demand(spark, sf_dir)))


# -- quality gates, sources and sinks ---------------------------------------------------------------

def register_test_tables(spark, sf_dir):
    for t in T.TABLES:
        T.read_table(spark, sf_dir, t).createOrReplaceTempView(t)


@register("table_counts")
def q_table_counts(spark, sf_dir):
    register_test_tables(spark, sf_dir)
    return quality.table_counts(spark, names=list(T.TABLES))


@register("table_gate")
def q_table_gate(spark, sf_dir):
    measured_run(spark, sf_dir).register_views()
    return quality.table_gate(spark)


@register("rubric_score")
def q_rubric_score(spark, sf_dir):
    return quality.rubric_score(T.read_table(spark, sf_dir, "documents"))


@register("rubric_verdict")
def q_rubric_verdict(spark, sf_dir):
    scores = quality.rubric_score(T.read_table(spark, sf_dir, "documents"))
    measured_run(spark, sf_dir).register_views()
    return quality.rubric_verdict(scores, quality.table_gate(spark))


@register("quality_summary")
def q_quality_summary(spark, sf_dir):
    run = measured_run(spark, sf_dir)
    return quality.quality_summary(run.listings, run.demand_panel, run.marketing, SUMMARY_SOURCE)


SUMMARY_SOURCE = "customer, nation, region, orders, events"


@register("sink_roundtrip")
def q_sink_roundtrip(spark, sf_dir):
    """Write the campaign panel as header CSV, read it back with its schema."""
    df = observed_marketing(spark, sf_dir)
    path = files.scratch_path(spark, "marketing_csv")
    files.write_csv(df, path)
    return stable(files.read_csv(spark, path, df.schema))


@register("warehouse_roundtrip")
def q_warehouse_roundtrip(spark, sf_dir):
    """The four warehouse tables written to the catalog, then counted from there."""
    database = "liftkit_roundtrip"
    files.save_warehouse(spark, measured_run(spark, sf_dir).warehouse(), database=database)
    return quality.table_counts(spark, names=list(quality.REQUIRED_TABLES), database=database)


@register("json_roundtrip")
def q_json_roundtrip(spark, sf_dir):
    """The run summary written as one JSON object and read back."""
    run = measured_run(spark, sf_dir)
    summary = quality.quality_summary(run.listings, run.demand_panel, run.marketing, SUMMARY_SOURCE)
    path = files.scratch_path(spark, "summary_json")
    files.write_json_summary(summary, path)
    return spark.read.schema(summary.schema).json(path)


@register("corpus_roundtrip")
def q_corpus_roundtrip(spark, sf_dir):
    """Document texts written as text files, one folder a source, and read as a corpus line by line:
    the number of documents and of characters per source."""
    docs = T.read_table(spark, sf_dir, "documents")
    path = files.scratch_path(spark, "corpus")
    docs.select("source", F.regexp_replace("text", r"\s+", " ").alias("line")).write.partitionBy("source").text(path)
    lines = files.read_corpus(spark, [f"{path}/source=*/*.txt"], whole=False)
    return lines.select(F.regexp_extract("path", "source=([^/]+)/", 1).alias("source"), "text").groupBy("source").agg(
        F.count(F.lit(1)).alias("n_documents"), F.sum(F.length("text")).alias("n_chars"))


@register("corpus_whole_files")
def q_corpus_whole_files(spark, sf_dir):
    """Texts written as they are, each followed by a byte that is no UTF-8, and read back as whole
    files: characters and line ends per source, the bad bytes left out."""
    docs = T.read_table(spark, sf_dir, "documents")
    path = files.scratch_path(spark, "corpus_whole")
    raw = F.concat(F.coalesce("text", F.lit("")).cast("binary"), F.unhex(F.lit("FF")))
    # a file is read as one value: its rows, not the input, bound its size
    docs.select("source", raw.cast("string").alias("line")).write.partitionBy("source").option("maxRecordsPerFile", 5_000).text(path)
    found = files.read_corpus(spark, [f"{path}/source=*/*.txt"])
    return found.select(F.regexp_extract("path", "source=([^/]+)/", 1).alias("source"), "text").groupBy("source").agg(
        F.sum(F.length("text")).alias("n_chars"),
        F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).cast("long").alias("n_line_ends"))


@register("export_index")
def q_export_index(spark, sf_dir):
    """The export's row index, as read back."""
    df = raw_listings(spark, sf_dir).select("id")
    path = files.scratch_path(spark, "export_index")
    files.write_export_with_index(df, path, order_by="id")
    return files.read_csv(spark, path, "row_index long, id long")


@register("src_listings")
def q_src_listings(spark, sf_dir):
    """Listing export written as CSV and scanned back with the explicit text schema."""
    raw = raw_listings(spark, sf_dir)
    path = files.scratch_path(spark, "listings_csv")
    files.write_csv(raw, path)
    return files.read_listings_csv(spark, path, raw.schema)


# -- features, splits and models --------------------------------------------------------------------

ONEHOT_SPEC = (["neighbourhood_group", "neighbourhood", "room_type"], ["G", "N", "R"])
NUMERIC_FEATURES = ["price", "number_of_reviews", "reviews_per_month"]


def classifier_frame(spark, sf_dir):
    """Listings -> label (availability > 165) + one-hot market, sub-market and room type."""
    df = profile.profile_select(cleaned_listings(spark, sf_dir), drop=["name", "host_id", "host_name", "last_review"])
    df = cleaning.binarize(df, "availability_365", 165).withColumnRenamed("availability_365", "label")
    df = ml.onehot(df, *ONEHOT_SPEC)
    return cleaning.drop_zero(df, "price")


def feature_columns(df):
    return NUMERIC_FEATURES + [c for c in df.columns if c[:2] in ("G_", "N_", "R_")]


def prepared_rows(spark, sf_dir):
    """Every labelled row, scaled and assembled."""
    df = classifier_frame(spark, sf_dir)
    feats = feature_columns(df)
    scaled = ml.standardize(df, feats).fillna(0.0, feats)  # missing price: the column mean
    return ml.assemble(scaled, feats).select("id", "label", "features")


def prepared_split(spark, sf_dir, test_fraction=0.3, seed=200):
    """Hash split, scaler fitted on the training rows only, features assembled."""
    df = ml.split_hash(classifier_frame(spark, sf_dir), "id", test_fraction, seed)
    feats = feature_columns(df)
    train = df.filter(F.col("split") == "train")
    scaled = ml.standardize(df, feats, fit_on=train).fillna(0.0, feats)  # missing price: the training mean
    # iterative estimators re-read their input every pass: keep the assembled rows
    data = ml.assemble(scaled, feats).select("id", "label", "split", "features").persist(StorageLevel.MEMORY_AND_DISK)
    return data.filter(F.col("split") == "train"), data.filter(F.col("split") == "test"), feats


def _accuracy_rows(model_name, pred_train, pred_test):
    a = metrics.accuracy(pred_train.withColumn("prediction", F.col("prediction").cast("int")))
    b = metrics.accuracy(pred_test.withColumn("prediction", F.col("prediction").cast("int")))
    return a.select(F.lit(model_name).alias("model"), F.lit("train").alias("split"), "accuracy").unionByName(
        b.select(F.lit(model_name).alias("model"), F.lit("test").alias("split"), "accuracy"))


@register("onehot")
def q_onehot(spark, sf_dir):
    return stable(classifier_frame(spark, sf_dir))


@register("src_export_reread")
def q_src_export_reread(spark, sf_dir):
    """Encoded table exported with a leading row index, re-read, index dropped."""
    df = classifier_frame(spark, sf_dir)
    path = files.scratch_path(spark, "export_csv")
    files.write_export_with_index(df, path, order_by="id")
    return stable(files.read_export(spark, path, df.schema))


@register("standardize")
def q_standardize(spark, sf_dir):
    df = cleaned_listings(spark, sf_dir).select("id", *NUMERIC_FEATURES)
    return stable(ml.standardize(df, NUMERIC_FEATURES))


@register("minmax_scale")
def q_minmax_scale(spark, sf_dir):
    df = cleaned_listings(spark, sf_dir).select("id", "price", "number_of_reviews")
    return stable(ml.minmax_scale(df, ["price", "number_of_reviews"]))


@register("split_hash")
def q_split_hash(spark, sf_dir):
    return ml.split_hash(classifier_frame(spark, sf_dir).select("id", "label"), "id", 0.3, 200)


@register("split_stratified")
def q_split_stratified(spark, sf_dir):
    return ml.split_stratified(classifier_frame(spark, sf_dir).select("id", "label"), "id", "label", 0.25, 0)


@register("majority_baseline")
def q_majority_baseline(spark, sf_dir):
    df = ml.split_hash(classifier_frame(spark, sf_dir).select("id", "label"), "id", 0.25, 0)
    train, test = df.filter(F.col("split") == "train"), df.filter(F.col("split") == "test")
    pred = ml.majority_predict(test, train)
    return stable(metrics.accuracy(pred).select(
        ml.majority_class(train).scalar().alias("majority"), "accuracy",
        test.agg(F.count(F.lit(1))).scalar().alias("n_test")))


def embeddings_split(spark, sf_dir):
    return ml.split_hash(T.read_table(spark, sf_dir, "embeddings"), "vec_id", 0.3, 0)


@register("knn_classify")
def q_knn_classify(spark, sf_dir):
    return stable(ml.knn_accuracy_curve(embeddings_split(spark, sf_dir), "vec_id", "embedding", "label"))


def raw_split(spark, sf_dir, test_fraction=0.3, seed=200):
    """Hash split with unscaled features as an array (trees don't depend on the scale); a missing
    number becomes the training mean."""
    df = ml.split_hash(classifier_frame(spark, sf_dir), "id", test_fraction, seed)
    feats = feature_columns(df)
    means = df.filter(F.col("split") == "train").agg(*[F.avg(c).alias(c) for c in NUMERIC_FEATURES]).first()
    filled = [F.coalesce(F.col(clean_fn.quoted(c)).cast("double"), F.lit(means[c] if c in NUMERIC_FEATURES else 0.0)) for c in feats]
    return df.select("id", "label", "split", F.array(*filled).alias("features")), feats


def fitted_tree(spark, sf_dir):
    rows, feats = raw_split(spark, sf_dir)
    return trees.grow(rows.filter(F.col("split") == "train"), feats, max_depth=2), rows


@register("tree_classify")
def q_tree_classify(spark, sf_dir):
    """Depth-2 tree over every distinct value of every feature: accuracy on both splits."""
    model, rows = fitted_tree(spark, sf_dir)
    hit = ((F.col("score") > 0.5).cast("int") == F.col("label")).cast("double")
    return stable(model.predict(rows, out="score").groupBy("split").agg(F.avg(hit).alias("accuracy")).select(
        F.lit("decision_tree_depth2").alias("model"), "split", "accuracy"))


@register("tree_importance")
def q_tree_importance(spark, sf_dir):
    """The tree's share of Gini gain per feature."""
    model, _ = fitted_tree(spark, sf_dir)
    return stable(spark.createDataFrame(list(model.importances().items()), "feature string, importance double"))


@register("rf_classify")
def q_rf_classify(spark, sf_dir):
    """A hundred exact-split trees on hashed bootstraps, a root's number of features a node."""
    rows, feats = raw_split(spark, sf_dir, 0.25, 0)
    model = trees.grow(rows.filter(F.col("split") == "train"), feats, trees.bootstrap_weights("id", 100, 0), 100, max_depth=5,
                       per_node=int(len(feats) ** 0.5))
    pred = model.predict(trees.spread(rows), out="score").withColumn("prediction", (F.col("score") > 0.5).cast("int"))
    test = pred.filter(F.col("split") == "test")
    auc = metrics.roc_auc(test).select(
        F.lit("random_forest_100").alias("model"), F.lit("test_auc").alias("split"), F.col("roc_auc").alias("accuracy"))
    return _accuracy_rows("random_forest_100", pred.filter(F.col("split") == "train"), test).unionByName(auc)


@register("gnb_classify")
def q_gnb_classify(spark, sf_dir):
    train, test, _ = prepared_split(spark, sf_dir, 0.25, 0)
    _, a, b = ml.fit_predict(ml.gaussian_nb(), train, test)
    return stable(_accuracy_rows("gaussian_nb", a, b))


def scaled_split(spark, sf_dir, test_fraction=0.25, seed=0):
    """Hash split, scaler fitted on the training rows only, features as an array."""
    df = ml.split_hash(classifier_frame(spark, sf_dir), "id", test_fraction, seed)
    feats = feature_columns(df)
    scaled = ml.standardize(df, feats, fit_on=df.filter(F.col("split") == "train")).fillna(0.0, feats)
    return scaled.select("id", "label", "split", F.array(*[F.col(clean_fn.quoted(c)) for c in feats]).alias("features")), feats


def logistic_models():
    """The published models: C = 1 and C = 0.1, on the training rows."""
    return {f"logreg_C{c}": (F.col("split") == "train", c) for c in (1.0, 0.1)}


@register("logreg_classify")
def q_logreg_classify(spark, sf_dir):
    """Both models fitted together by Newton steps: accuracy on both splits, area under the curve on
    the test rows."""
    rows, _ = scaled_split(spark, sf_dir)
    fitted = logistic.fit(rows, logistic_models())
    out = []
    for name in fitted.coef:
        pred = rows.withColumn("score", fitted.probability(name)).withColumn("prediction", (F.col("score") > 0.5).cast("int"))
        test = pred.filter(F.col("split") == "test")
        auc = metrics.roc_auc(test).select(
            F.lit(name).alias("model"), F.lit("test_auc").alias("split"), F.col("roc_auc").alias("accuracy"))
        out.append(_accuracy_rows(name, pred.filter(F.col("split") == "train"), test).unionByName(auc))
    return functools.reduce(DataFrame.unionByName, out)


@register("logreg_optimality")
def q_logreg_optimality(spark, sf_dir):
    """The gradient of both models' objectives at their coefficients: zero at the minimum."""
    rows, feats = scaled_split(spark, sf_dir)
    return logistic.optimality(rows, logistic.fit(rows, logistic_models()), logistic_models(), feats)


CV_FOLDS, CV_SEED = 5, 7


def fold_models():
    return {f"fold{k}": (F.col("fold") != k, 1.0) for k in range(CV_FOLDS)}


def fold_rows(spark, sf_dir):
    df = classifier_frame(spark, sf_dir)
    feats = feature_columns(df)
    scaled = ml.standardize(df, feats).fillna(0.0, feats)  # missing price: the column mean
    return scaled.select("id", "label", ml.fold_of("id", CV_FOLDS, CV_SEED).alias("fold"),
                         F.array(*[F.col(clean_fn.quoted(c)) for c in feats]).alias("features")), feats


@register("cross_val")
def q_cross_val(spark, sf_dir):
    """Logistic regression on every row, all folds' models fitted in the same passes; each row is
    judged by the model that did not see it."""
    rows, _ = fold_rows(spark, sf_dir)
    fitted = logistic.fit(rows, fold_models())
    score = functools.reduce(lambda c, k: c.when(F.col("fold") == k, fitted.probability(f"fold{k}")), range(CV_FOLDS), F)
    hit = ((score > 0.5).cast("int") == F.col("label")).cast("double")
    return rows.groupBy("fold").agg(F.lit("accuracy").alias("metric"), F.count(F.lit(1)).alias("n_rows"), F.avg(hit).alias("score"))


@register("cross_val_optimality")
def q_cross_val_optimality(spark, sf_dir):
    """The gradient of each fold's model at its coefficients, and the rows it learned from."""
    rows, feats = fold_rows(spark, sf_dir)
    return logistic.optimality(rows, logistic.fit(rows, fold_models()), fold_models(), feats)


@register("cross_val_recall")
def q_cross_val_recall(spark, sf_dir, n_trees=100):
    """Recall of the forest on every row, fold by fold (100 trees a fold; the published count, 1,000,
    is a parameter). All folds' forests grow together, a level a pass: tree t of fold k draws
    bootstrap t from the rows outside fold k."""
    df = classifier_frame(spark, sf_dir)
    feats = feature_columns(df)
    means = df.agg(*[F.avg(c).alias(c) for c in NUMERIC_FEATURES]).first()
    filled = [F.coalesce(F.col(clean_fn.quoted(c)).cast("double"), F.lit(means[c] if c in NUMERIC_FEATURES else 0.0)) for c in feats]
    rows = df.select("id", "label", ml.fold_of("id", CV_FOLDS, CV_SEED).alias("fold"), F.array(*filled).alias("features"))
    none = F.array_repeat(F.lit(0).cast("tinyint"), n_trees)
    inside = F.get(F.transform(F.array(trees.bootstrap_weights("id", n_trees, 0)), lambda w: F.flatten(F.array(*[
        F.when(F.col("fold") != k, w).otherwise(none) for k in range(CV_FOLDS)]))), F.lit(0))  # drawn once for all folds
    model = trees.grow(rows, feats, inside, CV_FOLDS * n_trees, max_depth=5, per_node=int(len(feats) ** 0.5))
    scored = model.predict_own(trees.spread(rows), "fold", [list(range(k * n_trees, (k + 1) * n_trees)) for k in range(CV_FOLDS)], out="score")
    pred = scored.withColumn("prediction", (F.col("score") > 0.5).cast("int"))
    tp = F.sum((F.col("prediction") * F.col("label")).cast("long"))
    return pred.groupBy("fold").agg(F.lit("recall").alias("metric"), F.count(F.lit(1)).alias("n_rows"),
                                    F.when(F.sum("label") > 0, tp / F.sum("label")).alias("score"))


@register("rf_regression")
def q_rf_regression(spark, sf_dir):
    """Forest on the campaign panel: holdout R^2 and per-market predicted bookings."""
    predicted, r2 = measurement.fit_demand_model(observed_marketing(spark, sf_dir))
    per_market = predicted.select(F.concat(F.lit("predicted:"), "borough").alias("name"),
                                  F.col("predicted_daily_experience_bookings").alias("value"))
    return spark.createDataFrame([("holdout_r2", r2)], "name string, value double").unionByName(per_market)


@register("forest_roots")
def q_forest_roots(spark, sf_dir):
    """Per tree of the demand forest: bootstrapped rows, their label mean, and the root's split
    (signals rounded to nine decimals, so both engines order them alike)."""
    rows = measurement.demand_rows(observed_marketing(spark, sf_dir)).filter(F.col("split") == "train").withColumn(
        "features", F.transform("features", lambda v: F.round(v, 9)))
    model = trees.grow(rows, scoring.SIGNALS, trees.bootstrap_weights("_key", 100, 42), 100, max_depth=1, min_leaf=4, seed=42)
    found = []
    for t in range(model.n_trees):
        n, total = model.nodes[t, trees.ROOT]
        f, cut, _ = model.splits.get((t, trees.ROOT), (None, None, None))
        found.append((t, int(n), total / n, None if f is None else scoring.SIGNALS[f], cut))
    return stable(spark.createDataFrame(found, "tree int, n_rows long, label_mean double, feature string, threshold double"))


# -- evaluation on scored documents ---------------------------------------------------------------------

def doc_predictions(spark, sf_dir):
    """labels + documents: label = quality; score = length score (tied values); predicted
    positive when score >= 0.7."""
    labels = T.read_table(spark, sf_dir, "labels")
    docs = T.read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    j = labels.join(docs, "doc_id")
    score = F.round(F.log1p(F.col("n_chars")) / 10.0, 1)
    return j.select(F.col("doc_id").alias("id"), F.col("quality").alias("label"), score.alias("score")).withColumn(
        "prediction", (F.col("score") >= 0.7).cast("int"))


@register("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(doc_predictions(spark, sf_dir), classes=[0, 1])


@register("accuracy")
def q_accuracy(spark, sf_dir):
    return stable(metrics.accuracy(doc_predictions(spark, sf_dir)))


@register("f1_score")
def q_f1_score(spark, sf_dir):
    return stable(metrics.f1_score(doc_predictions(spark, sf_dir)))


@register("classification_report")
def q_classification_report(spark, sf_dir):
    return stable(metrics.classification_report(doc_predictions(spark, sf_dir)))


@register("roc_auc")
def q_roc_auc(spark, sf_dir):
    return stable(metrics.roc_auc(doc_predictions(spark, sf_dir)))


@register("roc_auc_exact")
def q_roc_auc_exact(spark, sf_dir):
    """The AUC of an unrounded score: about as many ranks as documents."""
    labels = T.read_table(spark, sf_dir, "labels")
    docs = T.read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    pred = labels.join(docs, "doc_id").select(F.col("quality").alias("label"), (F.col("n_chars") / 7.0).alias("score"))
    return stable(metrics.roc_auc(pred))


@register("r2_score")
def q_r2_score(spark, sf_dir):
    from pyspark.sql import Window

    mp = observed_marketing(spark, sf_dir)
    pred = mp.select(F.col("experience_bookings").alias("label"),
                     F.avg("experience_bookings").over(Window.partitionBy("borough")).alias("prediction"))
    return stable(metrics.r2_score(pred))


@register("null_profile")
def q_null_profile(spark, sf_dir):
    return stable(profile.null_profile(raw_listings(spark, sf_dir)))
