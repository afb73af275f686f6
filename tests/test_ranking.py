"""The rank helper at a size where range samples, coalescing and pruning used to matter."""

import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftkit.operators import metrics, ml, quantiles, ranking
from liftkit.sources import files

N = 400_000


@pytest.fixture(scope="module")
def rows(spark):
    path = tempfile.mkdtemp(prefix="liftkit-rank-") + "/rows"
    key = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 15), 16, 10).cast("long")
    spark.range(N).select(
        "id", key.alias("key"), F.rand(3).alias("v"), (F.randn(4) * 50).alias("w"), F.concat(F.lit("p"), "id").alias("payload"),
        (F.col("id") % 5 == 0).cast("int").alias("label"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("g"),
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(params=[("8", "true", "true"), ("8", "false", "false"), ("40", "true", "false"), ("40", "false", "true")])
def settings(spark, request):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.exchange.reuse")
    before = {n: spark.conf.get(n) for n in names}
    for n, v in zip(names, request.param):
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def test_every_row_has_its_rank(rows, settings):
    r = ml.positions(rows, "key").agg(
        F.count("*"), F.min("position"), F.max("position"), F.count_distinct("position"), F.count("payload")).first()
    assert tuple(r) == (N, 0, N - 1, N, N)
    split = {(r["label"], r["split"]): r["count"] for r in ml.split_stratified(rows, "id", "label").groupBy("label", "split").count().collect()}
    assert split == {(1, "test"): 20_000, (1, "train"): 60_000, (0, "test"): 80_000, (0, "train"): 240_000}
    scored = rows.select(F.col("v").alias("score"), (F.col("v") > 0.5).cast("int").alias("label"))
    assert metrics.roc_auc(scored).first()["roc_auc"] == pytest.approx(1.0, abs=1e-12)


def test_quantiles_match_the_aggregate(rows, settings):
    want = rows.agg(F.percentile("w", 0.99)).first()[0]
    assert quantiles.quantile(rows, "w", 0.99).first()["quantile"] == pytest.approx(want, abs=1e-9)
    got = {r["g"]: r["quantile"] for r in quantiles.grouped_quantile(rows, ["g"], "w", 0.5).collect()}
    for r in rows.groupBy("g").agg(F.percentile("w", 0.5).alias("m")).collect():
        assert got[r["g"]] == pytest.approx(r["m"], abs=1e-9)


def test_export_keeps_every_row(spark, rows):
    path = files.scratch_path(spark, "rank_export")
    files.write_export_with_index(rows.select("key", "payload"), path, order_by="key")
    back = files.read_csv(spark, path, "row_index long, key long, payload string")
    assert tuple(back.agg(F.count("*"), F.count_distinct("row_index"), F.max("row_index")).first()) == (N, N, N - 1)
    assert back.orderBy("row_index").limit(1000).toPandas()["key"].is_monotonic_increasing


def test_buckets_never_decrease(spark):
    values = [None, float("-inf"), -1e300, -7.5, -7.4, -1e-300, -0.0, 0.0, 5e-324, 1e-9, 1.0, 1.01, 2.0, 1e18, 1.7e308, float("inf"), float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    b = [r["b"] for r in df.select("i", ranking.order_bucket(df, "x").alias("b")).orderBy("i").collect()]
    assert b == sorted(b) and b[6] == b[7]
    texts = sorted(["", "a", "a\0", "ab", "b", "zz", "é", "日本"], key=lambda s: s.encode())
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    b = [r["b"] for r in df.select("i", ranking.order_bucket(df, "x").alias("b")).orderBy("i").collect()]
    assert b == sorted(b)


@pytest.mark.parametrize("kind", ["string", "date", "decimal(10,2)", "int"])
def test_positions_of_other_types(spark, kind):
    rng = np.random.default_rng(1)
    text = [str(x) for x in rng.permutation(3000)]
    df = spark.createDataFrame([(t,) for t in text], "t string")
    x = F.expr("date_add(date'1960-01-01', cast(t as int))") if kind == "date" else F.col("t").cast(kind)
    got = ml.positions(df.select(x.alias("x")), "x").orderBy("position").toPandas()
    assert got["position"].tolist() == list(range(3000))
    assert got["x"].tolist() == sorted(got["x"].tolist(), key=lambda v: v.encode() if kind == "string" else v)


BOUND = 5_000
SHAPES = {
    "one prefix": "concat('user-0000-', lpad(cast(id as string), 9, '0'))",
    "very long prefix": "concat(repeat('x', 500), md5(cast(id as string)))",
    "prefixes of each other": "repeat('ab', cast(id % 300 as int))",
    "close scores": f"0.99D + id / {100 * N}D",
    "one outlier": "case when id = 7 then 1e300D else 1D + id * 1e-13D end",
    "a month": "timestamp_seconds(1704067200 + id * 6)",
    "near longs": f"{2 ** 60} + id",
    "decimal": "cast(1000000 + id / 1000D as decimal(18,3))",
    "hot value": "cast(case when id % 3 != 0 then 5 else id end as int)",
    "missing": "case when id % 2 = 0 then id end",
}


@pytest.mark.parametrize("shape", SHAPES)
def test_no_bucket_above_the_bound(spark, shape):
    n = 60_000
    df = spark.range(0, n, 1, 8).select("id", F.expr(SHAPES[shape]).alias("x"))
    b = ranking.bucketed(df, "x", bound=BOUND)
    assert b.groupBy("_bucket").count().agg(F.max("count")).first()[0] <= BOUND
    # buckets never overlap: each one's least value is at least the greatest of the one before
    spans = b.groupBy("_bucket").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("_bucket").collect()
    seen = [r for r in spans if r["lo"] is not None]
    key = (lambda v: v.encode()) if isinstance(seen[0]["lo"], str) else (lambda v: v)
    assert all(key(p["hi"]) <= key(q["lo"]) for p, q in zip(seen, seen[1:]))
    got = ranking.ordered_offsets(df, "x", bound=BOUND)
    assert tuple(got.agg(F.min("_before"), F.max("_before"), F.count_distinct("_before"), F.count("*")).first()) == (0, n - 1, n, n)
    x = [r["x"] for r in got.filter("x is not null").orderBy("_before").select("x").collect()]
    assert [key(v) for v in x] == sorted(key(v) for v in x)


def test_quantiles_over_cut_buckets(spark):
    df = spark.range(60_000).select((0.99 + F.rand(5) / 100).alias("v"), (F.col("id") % 3 == 0).cast("int").alias("g"))
    want = df.agg(F.percentile("v", 0.99)).first()[0]
    assert quantiles.grouped_quantile(df, [], "v", 0.99, bound=1_000).first()["quantile"] == pytest.approx(want, abs=1e-12)
    got = {r["g"]: r["quantile"] for r in quantiles.grouped_quantile(df, ["g"], "v", 0.5, bound=1_000).collect()}
    for r in df.groupBy("g").agg(F.percentile("v", 0.5).alias("m")).collect():
        assert got[r["g"]] == pytest.approx(r["m"], abs=1e-12)


def test_equal_rows_and_ties_stay_together(spark):
    df = spark.range(20_000).select(F.lit(1).alias("x"), (F.col("id") % 4).alias("y"))
    got = ranking.ordered_offsets(df, "x", bound=1_000)  # four different rows: nothing finer exists
    assert got.agg(F.count_distinct("_before"), F.max("_before")).first()[:] == (20_000, 19_999)
    tied = ranking.ordered_offsets(spark.range(20_000).select(F.lit(1).alias("x"), "id"), "x", tie=["id"], bound=1_000)
    assert tied.filter("_before != id").count() == 0
