"""Evaluation metrics against brute force; k-NN against brute force; splits; model floors."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftkit.operators import metrics, ml


def pred_fixture(spark, n=300, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rnd.random() < 0.4)
        s = round(rnd.random() * 0.6 + 0.3 * y, 1)  # coarse scores: many ties
        rows.append((i, y, int(s >= 0.5), s))
    return rows, spark.createDataFrame(rows, "id long, label int, prediction int, score double")


def test_auc_matches_pairwise(spark):
    rows, df = pred_fixture(spark)
    pos = [s for _, y, _, s in rows if y == 1]
    neg = [s for _, y, _, s in rows if y == 0]
    pairwise = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg) / (len(pos) * len(neg))
    assert metrics.roc_auc(df).first()["roc_auc"] == pytest.approx(pairwise, abs=1e-12)


def test_confusion_f1_report(spark):
    rows, df = pred_fixture(spark)
    tp = sum(1 for _, y, p, _ in rows if y == 1 and p == 1)
    fp = sum(1 for _, y, p, _ in rows if y == 0 and p == 1)
    fn = sum(1 for _, y, p, _ in rows if y == 1 and p == 0)
    cm = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(df).collect()}
    assert cm[(1, 1)] == tp and cm[(0, 1)] == fp and cm[(1, 0)] == fn and sum(cm.values()) == len(rows)
    assert metrics.f1_score(df).first()["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn))
    rep = {r["row"]: r for r in metrics.classification_report(df).collect()}
    assert rep["1"]["precision"] == pytest.approx(tp / (tp + fp))
    assert rep["1"]["recall"] == pytest.approx(tp / (tp + fn))
    assert rep["accuracy"]["f1"] == pytest.approx(metrics.accuracy(df).first()["accuracy"])
    assert rep["macro avg"]["support"] == len(rows)


def test_confusion_full_grid_with_constant_predictor(spark):
    df = spark.createDataFrame([(0, 1), (1, 1)], "label int, prediction int")
    cm = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(df).collect()}
    assert cm == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 1}
    assert metrics.f1_score(spark.createDataFrame([(0, 0)], "label int, prediction int")).first()["f1"] == 0.0


def test_r2(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.5), (4.0, 4.5)], "label double, prediction double")
    y, p = np.array([1, 2, 3, 4.0]), np.array([1.5, 2, 2.5, 4.5])
    want = 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert metrics.r2_score(df).first()["r2"] == pytest.approx(want)


def test_blocked_knn_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    n, dim = 120, 8
    vecs = rng.normal(size=(n, dim)).astype(np.float32)
    labels = rng.integers(0, 3, size=n)
    rows = [(i, vecs[i].tolist(), int(labels[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = ml.split_hash(df, "vec_id", 0.3, 0)
    split = {r["vec_id"]: r["split"] for r in df.select("vec_id", "split").collect()}
    got = {r["k"]: r for r in ml.knn_accuracy_curve(df, "vec_id", "embedding", "label", block_rows=16).collect()}
    train = [i for i in range(n) if split[i] == "train"]
    v64 = vecs.astype(np.float64)
    for k in range(1, 11):
        hits = {"train": [], "test": []}
        for i in range(n):
            d = ((v64[train] - v64[i]) ** 2).sum(1)
            order = sorted(range(len(train)), key=lambda j: (d[j], train[j]))[:k]
            counts = {}
            for j in order:
                counts[labels[train[j]]] = counts.get(labels[train[j]], 0) + 1
            pred = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[0][0]
            hits[split[i]].append(pred == labels[i])
        assert got[k]["train_accuracy"] == pytest.approx(np.mean(hits["train"]))
        assert got[k]["test_accuracy"] == pytest.approx(np.mean(hits["test"]))


def test_splits(spark):
    df = spark.range(2000).withColumn("label", (F.col("id") % 5 == 0).cast("int"))
    a = {r["id"]: r["split"] for r in ml.split_hash(df, "id", 0.3, 200).collect()}
    b = {r["id"]: r["split"] for r in ml.split_hash(df.repartition(7), "id", 0.3, 200).collect()}
    assert a == b  # stable under repartitioning
    assert 0.25 < sum(v == "test" for v in a.values()) / 2000 < 0.35
    st = ml.split_stratified(df, "id", "label", 0.25, 0).groupBy("label", "split").count().collect()
    got = {(r["label"], r["split"]): r["count"] for r in st}
    assert got[(1, "test")] == 100 and got[(0, "test")] == 400  # exact per-label share


def test_positions_are_dense(spark):
    df = spark.range(1000).withColumn("key", F.rand(1))
    pos = sorted(r["position"] for r in ml.positions(df, "key").collect())
    assert pos == list(range(1000))


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, c double")
    mm = [tuple(r) for r in ml.minmax_scale(df, ["x", "c"]).collect()]
    assert mm == [(0.0, 0.0), (0.5, 0.0), (1.0, 0.0)]
    st = [r["x"] for r in ml.standardize(df, ["x"]).collect()]
    assert st == pytest.approx([-1.224744871391589, 0.0, 1.224744871391589])


def test_onehot_missing_is_all_zero(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, g string")
    out = {r["id"]: r for r in ml.onehot(df, ["g"], ["G"]).collect()}
    assert out[3]["G_a"] == 0 and out[3]["G_b"] == 0 and out[1]["G_a"] == 1 and "g" not in out[1]


def test_classifiers_beat_floor(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        y = int(rng.random() < 0.5)
        rows.append((i, y, float(rng.normal(2.0 * y, 1.0)), float(rng.normal(0, 1))))
    df = ml.split_hash(spark.createDataFrame(rows, "id long, label int, a double, b double"), "id", 0.25, 0)
    data = ml.assemble(df, ["a", "b"])
    train, test = data.filter("split = 'train'"), data.filter("split = 'test'")
    for est in (ml.decision_tree(2), ml.random_forest_classifier(20), ml.gaussian_nb(),
                ml.logistic_regression(train.count())):
        pred = est.fit(train).transform(test).withColumn("prediction", F.col("prediction").cast("int"))
        assert metrics.accuracy(pred).first()["accuracy"] > 0.7
    base = ml.majority_predict(test, train)
    assert metrics.accuracy(base).first()["accuracy"] < 0.7


def test_cross_validation_recall_and_forest_scores(spark):
    from liftkit.operators import scoring

    rng = np.random.default_rng(2)
    rows = [(i, int(i % 2), float(rng.normal(3.0 * (i % 2), 1.0))) for i in range(300)]
    data = ml.assemble(spark.createDataFrame(rows, "id long, label int, a double"), ["a"])
    folds = ml.cross_validate(data, lambda d: ml.random_forest_classifier(10, 13), "id", folds=5, metric="recall")
    out = folds.collect()
    assert len(out) == 5 and all(r["metric"] == "recall" and r["score"] > 0.8 for r in out)

    # forest predictions as the fourth score term
    panel = []
    for m, base in (("A", 10.0), ("B", 20.0), ("C", 30.0)):
        for d in range(20):
            t, p = int(m != "A"), int(d >= 10)
            y = base + d * 0.1
            panel.append((m, d, t, p, y, 10 * y, 0.22 * 10 * y, 0.0, 1.0, 2.0, 3.0, 4.0, 5.0))
    mp = spark.createDataFrame(panel, "borough string, day_index int, treated_market int, post_period int, "
                               "experience_bookings double, gbv double, contribution_margin double, spend double, "
                               "demand_signal_score double, event_pressure double, intent_index double, "
                               "weather_favorability double, available_supply double")
    train = ml.assemble(mp.withColumnRenamed("experience_bookings", "label"), scoring.SIGNALS + ["day_index"])
    model = ml.random_forest_regressor(10, 1, 42).fit(train)
    feats = ml.assemble(scoring.market_features(mp).withColumn("day_index", F.lit(10)), scoring.SIGNALS + ["day_index"])
    pred = model.transform(feats).select("borough", F.col("prediction").alias("predicted_daily_experience_bookings"))
    scores = scoring.opportunity_scores(mp, predicted=pred, r2=0.5).collect()
    assert len(scores) == 3 and all(r["rf_holdout_r2"] == 0.5 for r in scores)
    assert all(r["predicted_daily_experience_bookings"] is not None for r in scores)
