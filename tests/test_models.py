"""Exact-split trees, hashed forests and Newton logistic regression against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from liftkit.operators import logistic, ml, trees


def naive_tree(x, y, w, depth, min_leaf):
    """{node: (feature, threshold)} by trying every midpoint; ties to feature, then value."""
    out = {}

    def visit(rows, node, left):
        n, s, q = w[rows].sum(), (w * y)[rows].sum(), (w * y * y)[rows].sum()
        if left == 0 or not n * q > s * s:
            return
        best = None
        for f in range(x.shape[1]):
            values = sorted(set(x[rows, f]))
            for a, b in zip(values, values[1:]):
                go = rows[x[rows, f] <= a]
                nl, sl = w[go].sum(), (w * y)[go].sum()
                if nl < min_leaf or n - nl < min_leaf:
                    continue
                score = sl * sl / nl + (s - sl) ** 2 / (n - nl)
                if best is None or score > best[0]:
                    best = (score, f, a, (a + b) / 2)
        if best is None:
            return
        out[node] = (best[1], best[3])
        side = x[rows, best[1]] <= best[2]
        visit(rows[side], 2 * node, left - 1)
        visit(rows[~side], 2 * node + 1, left - 1)

    visit(np.flatnonzero(w > 0), 1, depth)
    return out


def table(spark, x, y):
    rows = [(i, [float(v) for v in x[i]], None if y[i] is None else float(y[i])) for i in range(len(x))]
    return spark.createDataFrame(rows, "id long, features array<double>, label double")


@pytest.mark.parametrize("bound", [1_000_000, 20])  # 20: values dealt over several buckets
def test_trees_equal_the_naive_search(spark, bound):
    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, 40, 150) / 4, rng.normal(size=150).round(2), rng.integers(0, 2, 150)], axis=1)
    y = ((x[:, 0] > 5) ^ (x[:, 2] > 0)).astype(float) * 3 + rng.integers(0, 3, 150)
    df = table(spark, x, y)
    weights = trees.bootstrap_weights("id", 3, 9)
    w = np.array([r[0] for r in df.orderBy("id").select(weights).collect()], dtype=float)
    model = trees.grow(df, ["a", "b", "c"], weights, 3, max_depth=3, min_leaf=4, bound=bound)
    for t in range(3):
        want = naive_tree(x, y, w[:, t], 3, 4)
        got = {v: (f, c) for (tree, v), (f, c, _) in model.splits.items() if tree == t}
        assert got == want
    leaves = [r[0] for r in df.orderBy("id").select(model.leaf()).collect()]
    means = [np.mean([model.nodes[t, v][1] / model.nodes[t, v][0] for t, v in enumerate(row)]) for row in leaves]
    assert [r["prediction"] for r in model.predict(df).orderBy("id").collect()] == pytest.approx(means)
    for t in range(3):  # a leaf's mean is that of the weighted rows in it
        at = np.array([row[t] for row in leaves])
        for v in set(at):
            assert model.nodes[t, v] == (w[at == v, t].sum(), (w[:, t] * y)[at == v].sum())


def test_bootstrap_is_a_poisson_draw_of_the_key(spark):
    df = spark.range(20_000)
    w = np.array([r[0] for r in df.select(trees.bootstrap_weights("id", 2, 1)).collect()])
    again = np.array([r[0] for r in df.repartition(5).sort("id").select(trees.bootstrap_weights("id", 2, 1)).collect()])
    assert (w == again).all()
    assert w.mean() == pytest.approx(1, abs=0.03) and w.var() == pytest.approx(1, abs=0.05)
    assert abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.03


def test_tree_edges(spark):
    kind = "id long, features array<double>, label double"
    empty = trees.grow(spark.createDataFrame([], kind), ["a"])
    assert empty.splits == {} and empty.importances() == {"a": 0.0}
    one = spark.createDataFrame([(1, [1.0], 2.0)], kind)
    assert empty.predict(one).first()["prediction"] is None
    rows = [(i, [v], y) for i, (v, y) in enumerate(
        [(1.0, 0.0), (1.0, 0.0), (None, 1.0), (float("nan"), 1.0), (5.0, None), (-0.0, 0.0), (0.0, 0.0)])]
    df = spark.createDataFrame(rows, kind)
    model = trees.grow(df, ["a"], max_depth=1)
    assert model.nodes[0, 1] == (6.0, 2.0)  # the missing label took no part
    assert model.splits[0, 1][:2] == (0, 1.0)  # missing values on the right
    got = [r["prediction"] for r in model.predict(df).orderBy("id").collect()]
    assert got == [0.0, 0.0, 1.0, 1.0, 1.0, 0.0, 0.0]
    same = trees.grow(spark.createDataFrame([(i, [1.0], float(i % 2)) for i in range(6)], kind), ["a"])
    assert same.splits == {} and same.nodes[0, 1] == (6.0, 3.0)


def test_feature_subsets_and_importances(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(200, 5)).round(2), None
    y = (x[:, 1] > 0.2).astype(float)
    df = table(spark, x, y)
    model = trees.grow(df, list("abcde"), trees.bootstrap_weights("id", 12, 0), 12, max_depth=3, per_node=2)
    share = model.importances()
    assert max(share, key=share.get) == "b" and sum(share.values()) == pytest.approx(1)
    assert len({model.splits[t, 1][0] for t in range(12) if (t, 1) in model.splits}) > 1  # roots see other features
    for (t, v), (f, _, _) in model.splits.items():
        assert f in trees._subset(0, t, v, 5, 2)


def test_newton_finds_the_minimum_of_every_model(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3))
    y = (rng.random(300) < 1 / (1 + np.exp(-(x @ [2.0, -1.0, 0.0] + 0.5)))).astype(float)
    df = table(spark, x, y).withColumn("fold", F.col("id") % 3)
    models = {"all.rows": (F.lit(True), 1.0), "weak": (F.lit(True), 0.01), "fold0": (F.col("fold") != 0, 1.0)}
    fitted = logistic.fit(df, models)
    assert fitted.steps < 15
    for name, (_, c) in models.items():
        use = np.arange(300) % 3 != 0 if name == "fold0" else np.ones(300, dtype=bool)
        one = np.hstack([x[use], np.ones((use.sum(), 1))])
        beta = fitted.coef[name]
        p = 1 / (1 + np.exp(-one @ beta))
        assert np.abs(one.T @ (p - y[use]) + np.array([*beta[:3] / c, 0.0])).max() < 1e-6
    rows = logistic.optimality(df, fitted, models, ["a", "b", "c"]).collect()
    assert len(rows) == 12 and all(r["gradient"] == 0 for r in rows)
    assert {r["model"]: r["n_train"] for r in rows} == {"all.rows": 300, "weak": 300, "fold0": 200}
    off = logistic.Logistic({n: b + 0.1 for n, b in fitted.coef.items()}, fitted.c)
    assert any(r["gradient"] != 0 for r in logistic.optimality(df, off, models, ["a", "b", "c"]).collect())


def test_newton_edges(spark):
    kind = "id long, features array<double>, label double"
    assert logistic.fit(spark.createDataFrame([], kind), {"m": (F.lit(True), 1.0)}).coef == {}
    rows = [(i, [1e4 * (i - 3)], float(i > 3)) for i in range(8)] + [(9, [0.0], None)]
    far = logistic.fit(spark.createDataFrame(rows, kind), {"m": (F.lit(True), 1.0)})
    assert np.isfinite(far.coef["m"]).all()
    with pytest.raises(Exception, match="impute first"):
        logistic.fit(spark.createDataFrame([(1, [None], 1.0), (2, [1.0], 0.0)], kind), {"m": (F.lit(True), 1.0)})
    kept = {r["p"] for r in spark.createDataFrame([(1, [0.0], 1.0)], kind).select(far.probability("m").alias("p")).collect()}
    assert all(0 <= p <= 1 for p in kept)


def knn_table(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in x[i]], i % 3) for i in range(len(x))],
                                 "vec_id long, embedding array<float>, label int")


def check_knn(spark, x, train_rows, k, **kw):
    df = knn_table(spark, x)
    train = df.filter(F.col("vec_id").isin(train_rows))
    got = {}
    for r in ml.knn_neighbours(train, df, k, "vec_id", "embedding", "label", **kw).collect():
        got.setdefault(r["qid"], {})[r["rank"]] = (r["tid"], r["dist"])
    v = x.astype(np.float32).astype(np.float64)
    for i in range(len(x)):
        d = np.sqrt(((v[train_rows] - v[i]) ** 2).sum(1))
        want = sorted(zip(d, train_rows))[:k]
        assert [got[i][r + 1][0] for r in range(len(want))] == [t for _, t in want]
        assert [got[i][r + 1][1] for r in range(len(want))] == pytest.approx([a for a, _ in want])
    assert len(got) == len(x)


def test_knn_cells_equal_brute_force_and_rule_cells_out(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(8, 6)) * 50
    x = np.concatenate([c + rng.normal(size=(50, 6)) for c in centres])
    train_rows = list(range(0, 400, 2))
    check_knn(spark, x, train_rows, 5, block_rows=10)
    df = knn_table(spark, x)
    train = df.filter(F.col("vec_id").isin(train_rows))
    found, visits, blocks, _ = ml.knn_cells(train, df, 5, "vec_id", "embedding", "label", block_rows=10)
    rows = blocks.groupBy("cell", "part").count()
    assert rows.agg(F.max("count")).first()[0] <= 30
    compared = visits.join(rows, ["cell", "part"]).agg(F.sum("count")).first()[0]
    assert compared + 400 * 30 < 0.4 * 400 * len(train_rows)


def test_knn_hot_copies_ties_and_edges(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(90, 3)).round(1)
    x[10:50] = x[10]  # nearly half of the rows are one vector: ties go to the smaller id
    check_knn(spark, x, list(range(60)), 4, block_rows=8)
    check_knn(spark, x, [3, 7], 4)  # fewer training rows than k
    df = knn_table(spark, x[:5])
    none = ml.knn_neighbours(df.filter("false"), df, 2, "vec_id", "embedding", "label")
    assert none.collect() == []
    gone = df.withColumn("embedding", F.when(F.col("vec_id") != 2, F.col("embedding")))
    ids = {(r["qid"], r["tid"]) for r in ml.knn_neighbours(gone, gone, 9, "vec_id", "embedding", "label").collect()}
    assert ids == {(i, j) for i in (0, 1, 3, 4) for j in (0, 1, 3, 4)}


def test_whole_files_leave_bad_bytes_out(spark, tmp_path):
    from liftkit.sources import files

    cases = {"a.txt": b"caf\xc3\xa9 \xff\xfebar\n\nend", "b.txt": b"", "c.txt": "kept � sign".encode(), "d.txt": b"\xe2\x82"}
    for name, body in cases.items():
        (tmp_path / name).write_bytes(body)
    got = {r["path"].rsplit("/", 1)[1]: r["text"] for r in files.read_corpus(spark, [str(tmp_path / "*.txt")]).collect()}
    assert got == {n: b.decode("utf-8", errors="ignore") for n, b in cases.items() if b}  # an empty file has no row
    lines = [r["text"] for r in files.read_corpus(spark, [str(tmp_path / "a.txt")], whole=False).collect()]
    assert lines == ["café bar", "", "end"]


def test_knn_visits_come_in_bounded_frames_and_distances_in_slices(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 6))
    pivots = x[:30]
    away = np.sqrt(((x[:, None] - pivots[None]) ** 2).sum(2))
    home = away.argmin(1)
    cells = [(c, 0.0, float(away.max()), 1, 4) for c in range(30)]  # nothing is ruled out
    rows = pd.DataFrame({"qid": range(120), "qvec": list(x), "dists": [[]] * 120, "cell": home, "part": 0})
    monkeypatch.setattr(ml, "KNN_VISITS", 100)
    frames = list(ml._cells_to_visit(pivots, cells, 5)([rows]))
    assert max(map(len, frames)) == 100 and sum(map(len, frames)) == 120 * 29
    whole = ml._cell_topk(5)
    q = pd.DataFrame({"qid": range(120), "qvec": list(x)})
    t = pd.DataFrame({"tid": range(120), "tvec": list(x), "tlabel": 0})
    asked = []
    partition = np.partition
    monkeypatch.setattr(ml.np, "partition", lambda d, *a, **k: asked.append(d.size) or partition(d, *a, **k))
    before = whole((0,), q, t)
    monkeypatch.setattr(ml, "KNN_CELLS", 1000)
    after = whole((0,), q, t)
    assert max(asked[1:]) <= 1000 and [list(v) for v in before["tids"]] == [list(v) for v in after["tids"]]
    split = [list(ml._to_pivots(pivots, "q")(iter([q.copy()])))[0]["cell"].tolist()]
    assert split[0] == home.tolist()


def test_cells_leave_a_task_summed_and_rows_are_spread(spark):
    rng = np.random.default_rng(11)
    rows = [(i, [float(rng.integers(2)), float(rng.integers(3))], float(rng.integers(2))) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, features array<double>, label double").coalesce(1)
    weights = trees.bootstrap_weights("id", 20, 0)
    data = df.select(F.col("label").alias("y"), F.col("features").alias("x"), weights.alias("w"))
    cells = data.mapInArrow(trees._sums(trees.Forest(["a", "b"], 20), 0, {}), trees.CELLS).collect()
    assert len(cells) == 20 * (2 + 3)  # not one a row, tree and feature
    drawn = {r["id"]: r["w"] for r in df.select("id", weights.alias("w")).collect()}
    want = sum(drawn[i][7] * y for i, x, y in rows if x[1] == 2.0)
    assert [c["s"] for c in cells if (c["tree"], c["feature"], c["value"]) == (7, 1, 2.0)] == [want]
    assert trees.spread(df).rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism


def test_features_of_many_values_are_dealt_by_ranges(spark, monkeypatch):
    rng = np.random.default_rng(12)
    x = np.stack([rng.normal(size=400).round(2), rng.integers(0, 3, 400), rng.normal(size=400).round(3) * 50], axis=1)
    x[:150, 2] = 7.5  # a common value, which several quantiles fall on
    x[150:160, 2], x[160:165, 0] = -0.0, 0.0
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 5) ^ (rng.random(400) < 0.2)) + rng.integers(0, 3, 400).astype(float)
    df, weights = table(spark, x, y), trees.bootstrap_weights("id", 2, 9)
    w = np.array([r[0] for r in df.orderBy("id").select(weights).collect()], dtype=float)
    monkeypatch.setattr(trees, "LONG", 20)
    counted, given = trees._sums, []
    monkeypatch.setattr(trees, "_sums", lambda *a: given.append(a[3:]) or counted(*a))
    model = trees.grow(df, ["a", "b", "c"], weights, 2, max_depth=2, min_leaf=2)
    assert given[0] == ((0, 2),)  # no cell a value for these two
    for t in range(2):
        assert {v: (f, c) for (tree, v), (f, c, _) in model.splits.items() if tree == t} == naive_tree(x, y, w[:, t], 2, 2)
    some = trees.grow(df, ["a", "b", "c"], weights, 2, max_depth=2, per_node=1)
    monkeypatch.setattr(trees, "LONG", 4096)
    same = trees.grow(df, ["a", "b", "c"], weights, 2, max_depth=2, per_node=1)
    assert some.splits == same.splits and some.nodes == same.nodes


def test_missing_values_and_weights_where_rows_are_dealt_by_ranges(spark, monkeypatch):
    monkeypatch.setattr(trees, "LONG", 3)
    rows = [(i, [None if i % 7 == 0 else float("nan") if i % 11 == 0 else float(i % 20)], None if i == 5 else float(i % 20 > 12 or i % 7 == 0))
            for i in range(80)]
    df = spark.createDataFrame(rows, "id long, features array<double>, label double")
    weights = F.when(F.col("id") != 9, F.array(F.lit(1).cast("tinyint")))
    model = trees.grow(df, ["a"], weights, 1, max_depth=3)
    monkeypatch.setattr(trees, "LONG", 4096)
    same = trees.grow(df, ["a"], weights, 1, max_depth=3)
    assert model.splits and model.splits == same.splits and model.nodes == same.nodes
    assert model.nodes[0, 1][0] == 78  # neither the row without a label nor that without a weight


def test_rows_predicted_by_the_trees_of_their_own_group(spark):
    rng = np.random.default_rng(13)
    x = rng.normal(size=(60, 2)).round(2)
    df = table(spark, x, (x[:, 0] > 0).astype(float)).withColumn("fold", F.when(F.col("id") < 50, F.col("id") % 2))
    model = trees.grow(df, ["a", "b"], trees.bootstrap_weights("id", 6, 2), 6, max_depth=2)
    groups = [[0, 1, 2], [3, 4, 5]]
    want = model.predict(df, trees={"g0": groups[0], "g1": groups[1]}).select("id", F.when(F.col("fold") == 0, F.col("g0")).when(F.col("fold") == 1, F.col("g1")))
    assert dict(model.predict_own(df, "fold", groups).select("id", "prediction").collect()) == dict(want.collect())


def test_knn_visits_are_not_shuffled(spark, monkeypatch):
    rng = np.random.default_rng(14)
    x = rng.normal(size=(150, 6)).round(1)
    x[20:40] = x[20]
    asked, compare = [], ml._compare
    monkeypatch.setattr(ml, "_compare", lambda *a: asked.append(a) or compare(*a))
    monkeypatch.setattr(ml, "KNN_CELLS", 60)  # distances in many slices
    check_knn(spark, x, list(range(0, 150, 2)), 5, block_rows=8)
    assert len(asked) == 1  # the first blocks only
    train = knn_table(spark, x)
    plan = ml.knn_neighbours(train, train, 5, "vec_id", "embedding", "label", block_rows=8)._jdf.queryExecution().executedPlan().toString()
    assert "CoGroups" not in plan and plan.count("Exchange") == 1  # the nearest of each query
