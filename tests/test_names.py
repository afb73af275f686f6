"""Level and column names with dots, quotes and backticks."""

from liftkit.operators import ml, profile


def test_odd_names_through_the_chain(spark):
    levels = ["St. George", "Prince's Bay", "a`b", "back\\slash", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(levels)], "id long, n string")
    wide = ml.onehot(df, ["n"], ["N"])
    names = sorted(f"N_{v}" for v in levels if v)
    assert sorted(c for c in wide.columns if c != "id") == names
    rows = {r["id"]: r.asDict() for r in wide.collect()}
    for i, v in enumerate(levels):
        assert {c for c in names if rows[i][c] == 1} == ({f"N_{v}"} if v else set())
    found = {r["column_name"]: r["missing"] for r in profile.null_profile(wide).collect()}
    assert found == {c: 0 for c in wide.columns}
    assert profile.distinct_values(wide.withColumnRenamed("N_a`b", "it's`")).count() == 0
    vectors = ml.assemble(ml.standardize(wide, names), names).select("features").collect()
    assert len(vectors) == 5 and len(vectors[0]["features"]) == 4


def test_sparse_form_of_missing_is_all_zeros(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "n string")
    out = ml.onehot_vector(df, ["n"]).fit(df).transform(df).collect()
    assert sorted((r["n"] or "", float(sum(r["n__vec"]))) for r in out) == [("", 0.0), ("a", 1.0), ("b", 1.0), ("b", 1.0)]


def test_many_levels_give_one_sparse_column(spark):
    df = spark.range(30).selectExpr("id", "concat('l', id) AS n")
    out = ml.onehot(df, ["n"], ["N"], max_levels=10)
    assert out.columns == ["id", "N_vec"] and all(sum(r["N_vec"]) == 1 for r in out.collect())


def test_the_wide_form_stays_wide(spark):
    df = spark.range(1001).selectExpr("id", "concat('l', id) AS n")
    out = ml.onehot(df, ["n"], ["N"])
    assert len(out.columns) == 1002 and "N_l1000" in out.columns


def test_coordinates_hold_any_number_of_levels(spark):
    df = spark.range(5001).selectExpr("id AS `row.id`", "if(id = 5000, null, concat('l', id)) AS `a.b`", "id % 3 AS g")
    ones, levels = ml.onehot_coordinates(df, "row.id", ["a.b", "g"])
    table = {(r["column"], r["level"]): r["slot"] for r in levels.collect()}
    assert sorted(table.values()) == list(range(5003)) and [table["g", str(i)] for i in range(3)] == [5000, 5001, 5002]
    got = sorted((r["id"], r["slot"]) for r in ones.collect())
    assert got == sorted([(i, table["a.b", f"l{i}"]) for i in range(5000)] + [(i, table["g", str(i % 3)]) for i in range(5001)])


def test_minmax_of_a_dotted_name(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "`a.b` double")
    assert [r[0] for r in ml.minmax_scale(df, ["a.b"]).collect()] == [0.0, 1.0, None]


def test_confusion_zeros_at_any_size(spark):
    from liftkit.operators import metrics

    df = spark.range(1001).selectExpr("id AS label", "id AS prediction")
    full = metrics.confusion_matrix(df)
    assert full.count() == 1001 ** 2 and full.filter("n > 0").count() == 1001
    assert metrics.confusion_matrix(df, sparse=True).count() == 1001
