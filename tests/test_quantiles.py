"""Distributed exact quantile against pandas and Spark's own percentile aggregate."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from liftkit.operators.quantiles import grouped_quantile, quantile


@pytest.mark.parametrize("q", [0.0, 0.37, 0.5, 0.99, 1.0])
def test_quantile_matches_pandas(spark, q):
    rng = np.random.default_rng(0)
    n = 3000
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c", None], size=n, p=[0.6, 0.2, 0.15, 0.05]),
                        "x": np.round(rng.normal(size=n) * 10, 1)})
    pdf.loc[rng.choice(n, 200), "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(F.isnan("x"), None).otherwise(F.col("x")))
    got = {r["g"]: r["quantile"] for r in grouped_quantile(df, ["g"], "x", q).collect()}
    want = pdf.dropna(subset=["g"]).groupby("g")["x"].quantile(q).to_dict()
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9)
    assert quantile(df, "x", q).first()["quantile"] == pytest.approx(pdf["x"].quantile(q), abs=1e-9)
    assert df.agg(F.percentile("x", q)).first()[0] == pytest.approx(pdf["x"].quantile(q), abs=1e-9)


def test_single_value_and_hot_group(spark):
    rows = [("hot", float(i % 50)) for i in range(5000)] + [("cold", 7.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r["quantile"] for r in grouped_quantile(df, ["g"], "x", 0.5).collect()}
    assert got == {"hot": pytest.approx(24.5), "cold": 7.0}
