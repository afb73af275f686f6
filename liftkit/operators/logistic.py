"""L2 logistic regression by Newton steps, many models in one pass a step.

A model is a name, a condition on the rows it learns from and the published ``C``. Each step sums
the gradient and the outer products p (1 - p) x x' of every model that is not finished, per
partition in numpy and then by position in Spark, so (d + 1)(d + 2) numbers a model reach the driver
however many rows there are. The step is solved there; one that raises the objective is halved.

The objective is the sum of log losses plus |w|^2 / (2C); the intercept is free. At its minimum
the gradient is zero, which ``optimality`` measures in a pass of its own and SQL can state.

Defined cases: rows with a missing label or condition take no part; a missing or NaN feature
raises an error, so impute first; repeated rows count as often as they stand; a model without rows or
with one label only has no finite minimum for its intercept and keeps the weights of its last step.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Logistic:
    """Coefficients (the intercept last) per model name."""

    coef: dict = field(default_factory=dict)
    c: dict = field(default_factory=dict)
    steps: int = 0

    def probability(self, name: str, features_col: str = "features") -> Column:
        """The probability of label 1 under a model, from built-in functions."""
        *w, b = (float(v) for v in self.coef[name])
        pairs = F.zip_with(F.col(features_col), F.array(*[F.lit(v) for v in w]), lambda x, y: x * y)
        return 1 / (1 + F.exp(-(F.aggregate(pairs, F.lit(b), lambda a, v: a + v))))


def _partials(coef: dict):
    """Per partition and model: rows, loss, gradient and Hessian of the log losses, flattened."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {}
        for b in batches:
            if len(b) == 0:
                continue
            x = np.stack([np.array(v, dtype=np.float64) for v in b["x"]])
            if not np.isfinite(x).all():
                raise ValueError("a feature is missing or not finite; impute first")
            x = np.hstack([x, np.ones((len(x), 1))])
            y = b["y"].to_numpy(dtype=np.float64)
            member = np.stack([np.array(v, dtype=bool) for v in b["m"]])
            for m, beta in coef.items():
                xs, ys = x[member[:, m]], y[member[:, m]]
                z = xs @ beta
                p = 0.5 * (1 + np.tanh(z / 2))
                loss = np.logaddexp(0, z).sum() - (ys * z).sum()
                h = (xs * (p * (1 - p))[:, None]).T @ xs
                flat = np.concatenate([[len(ys), loss], xs.T @ (p - ys), h.ravel()])
                sums[m] = flat + sums.get(m, 0.0)
        if sums:  # an empty partition puts out nothing
            yield pd.DataFrame({"model": list(sums), "sums": [v.tolist() for v in sums.values()]}).astype({"model": "int32"})
    return run


def fit(df: DataFrame, models: dict[str, tuple[Column, float]], label: str = "label", features_col: str = "features",
        tolerance: float = 1e-9, max_steps: int = 60) -> Logistic:
    """Fit every model of ``{name: (rows it learns from, C)}``. ``features_col`` is an array of
    doubles, ``label`` is 0/1. A model is finished when no gradient entry exceeds ``tolerance``
    times its rows (at least 1)."""
    names = list(models)
    data = df.select(
        F.col(features_col).alias("x"), F.col(label).cast("double").alias("y"),
        F.array(*[F.coalesce(models[n][0], F.lit(False)) for n in names]).alias("m")).filter(F.col("y").isNotNull()).persist(
        StorageLevel.MEMORY_AND_DISK)
    out = Logistic(c={n: models[n][1] for n in names})
    try:
        first = data.select(F.size("x")).first()
        if first is None:
            return out
        d = first[0] + 1
        now = {i: np.zeros(d) for i in range(len(names))}
        base, moved, live = {}, {}, set(now)
        for _ in range(max_steps):
            part = data.mapInPandas(_partials({i: now[i] for i in live}), "model int, sums array<double>")
            total = part.select("model", F.posexplode("sums").alias("at", "v")).groupBy("model", "at").agg(F.sum("v").alias("v"))
            got = {i: np.zeros(2 + d + d * d) for i in live}
            for r in total.collect():
                got[r["model"]][r["at"]] = r["v"]
            out.steps += 1
            for i in sorted(live):
                rows, loss, g, h = got[i][0], got[i][1], got[i][2:2 + d], got[i][2 + d:].reshape(d, d)
                ridge = np.full(d, 1.0 / models[names[i]][1])
                ridge[-1] = 0.0
                loss += 0.5 * (ridge * now[i] ** 2).sum()
                if i in base and loss > base[i][1] * (1 + 1e-12) + 1e-12 and np.abs(moved[i]).max() > 1e-12:
                    moved[i] = moved[i] / 2
                    now[i] = base[i][0] + moved[i]
                    continue
                g = g + ridge * now[i]
                if np.abs(g).max() <= tolerance * max(1.0, rows):
                    live.discard(i)
                    continue
                base[i] = (now[i], loss)
                moved[i] = -np.linalg.lstsq(h + np.diag(ridge), g, rcond=None)[0]
                now[i] = now[i] + moved[i]
            if not live:
                break
        out.coef = {names[i]: now[i] for i in now}
    finally:
        data.unpersist()
    return out


def optimality(df: DataFrame, fitted: Logistic, models: dict[str, tuple[Column, float]], features: list[str],
               label: str = "label", features_col: str = "features", digits: int = 6) -> DataFrame:
    """(model, coefficient, n_train, gradient): the objective's gradient at the fitted
    coefficients, rounded; zero at the minimum. One aggregate over all rows and models."""
    terms = []
    for i, (name, (rows, c)) in enumerate(models.items()):
        miss = F.when(F.coalesce(rows, F.lit(False)), fitted.probability(name, features_col) - F.col(label))
        for j, f in enumerate([*features, "(intercept)"]):
            x = F.col(features_col)[j] if j < len(features) else F.lit(1.0)
            pull = float(fitted.coef[name][j]) / c if j < len(features) else 0.0
            terms.append(F.struct(F.lit(name).alias("model"), F.lit(f).alias("coefficient"), F.count(f"_e_{i}").alias("n_train"),
                                  (F.round(F.sum(F.col(f"_e_{i}") * x) + F.lit(pull), digits) + F.lit(0.0)).alias("gradient")))
        df = df.withColumn(f"_e_{i}", miss)
    return df.agg(F.array(*terms).alias("t")).select(F.explode("t").alias("t")).select("t.*")
