"""Exact-split decision trees and forests, grown level by level.

Every midpoint between two neighbouring distinct values of a feature is a candidate, so nothing is
binned. One level is one grouped count: each task sums bounded slices of its rows by (tree, node,
feature, value) in NumPy, Spark sums those, and running sums in value order give both sides of every candidate. The
running sums use value buckets (``ranking.bucketed``), so a feature with any number of distinct
values is spread over tasks. Only the chosen split of each node comes to the driver: at most
trees x 2^max_depth rows, the model itself.

A feature with more than ``LONG`` distinct values would make about a cell of every row, tree and
level. Its rows are dealt once by ranges of its value instead, and in a level only the sums of each
(tree, node, range) leave a task; with the sums of the ranges before its own, a task then tries all
values of a range by itself and puts out the best of each (tree, node). A border between two ranges
is a range of its own, and the rows of a common one lie in several tasks. The
driver holds a number for each (tree, node, range); the ranges are a few for each core, or a few
for each ``SLICE_BYTES`` of weights.

The criterion is sum(y)^2 / n on the left plus the same on the right, to be largest. For numbers
that is least squares; for 0/1 labels it orders splits exactly as the Gini impurity does. Ties go
to the lower feature number, then the lower value. A node is split while its labels differ, it is
above ``max_depth`` and both children keep ``min_leaf`` rows.

Bootstraps are a function of the row's key and the tree's number: the row's weight is a Poisson(1)
draw from an md5 hash, so a recomputed task draws the same rows and other engines can follow. A row
without a weight in a tree takes no part in it.

Defined cases: rows with a missing label or a missing or NaN feature raise no error in growth: a
missing label takes no part; a missing, NaN or infinite feature value goes right, and the largest
known value is then a candidate too. Repeated rows count as often as they stand. An empty table gives trees without nodes, which predict null.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftkit.functions.clean import quoted
from liftkit.operators import ranking
from liftkit.operators.ml import HASH_SPAN

ROOT = 1  # the children of node v are 2v and 2v + 1
SLICE_BYTES = 50_000_000  # weights that a task holds at once
LONG = 4096  # distinct values above which a feature's rows are dealt by ranges of its value
CELLS = "tree int, node int, feature int, value double, n double, s double, q double"
RANGES = "tree int, node int, feature int, part int, n double, s double, q double, low double"
RANGE_BEST = "tree int, node int, feature int, minus double, value double, cut double, nl double, sl double"


@dataclass
class Forest:
    """Fitted trees. ``splits[tree, node]`` is (feature, threshold, gain): values up to the
    threshold go left; ``nodes[tree, node]`` is (rows, label sum), both weighted."""

    features: list[str]
    n_trees: int
    splits: dict = field(default_factory=dict)
    nodes: dict = field(default_factory=dict)

    def leaf(self, features_col: str = "features") -> Column:
        """The leaf that each tree puts a row in, as an array over the trees."""
        feature, cut = _tables(self)

        @F.pandas_udf("array<int>")
        def descend(rows: pd.Series) -> pd.Series:
            return pd.Series([n for node in _descend(rows, feature, cut) for n in node.astype(np.int32)], dtype=object)

        return descend(F.col(features_col))

    def predict(self, df: DataFrame, features_col: str = "features", out: str = "prediction",
                trees: dict | None = None) -> DataFrame:
        """``out``: the mean over the trees of the leaf's label mean (for 0/1 labels the
        probability of 1). ``trees`` maps a name to the trees it averages, giving one column for each."""
        value, (feature, cut) = _means(self), _tables(self)
        groups = {out: list(range(self.n_trees))} if trees is None else trees
        index = [np.array(g, dtype=np.int64) for g in groups.values()]

        @F.pandas_udf("array<double>")
        def means(rows: pd.Series) -> pd.Series:
            out = []
            for node in _descend(rows, feature, cut):
                p = value[np.arange(node.shape[1])[None, :], node]
                out += list(np.stack([p[:, g].mean(axis=1) for g in index], axis=1))
            return pd.Series(out, dtype=object)

        scored = df.withColumn("_means", means(F.col(features_col)))
        for i, name in enumerate(groups):
            m = F.col("_means")[i]
            scored = scored.withColumn(name, F.when(F.isnan(m), F.lit(None)).otherwise(m))
        return scored.drop("_means")

    def predict_own(self, df: DataFrame, group: str, groups: list[list[int]], features_col: str = "features",
                    out: str = "prediction") -> DataFrame:
        """As ``predict``, by the trees of the row's own group only: ``group`` is its number in ``groups``."""
        value, (feature, cut) = _means(self), _tables(self)
        index = [np.array(g, dtype=np.int64) for g in groups]

        @F.pandas_udf("double")
        def mean(rows: pd.Series, of: pd.Series) -> pd.Series:
            out, of = np.full(len(rows), np.nan), of.to_numpy(np.float64)
            for k, g in enumerate(index):
                at = np.flatnonzero(of == k)
                p = [value[g][np.arange(len(g))[None, :], node].mean(axis=1) for node in _descend(rows.iloc[at], feature[g], cut[g])]
                out[at] = np.concatenate(p) if p else []
            return pd.Series(out)

        scored = df.withColumn(out, mean(F.col(features_col), F.col(group).cast("double")))
        return scored.withColumn(out, F.when(F.isnan(out), F.lit(None)).otherwise(F.col(out)))

    def importances(self) -> dict[str, float]:
        """Each feature's share of the criterion's gain: per tree as a share, averaged over the
        trees that split at all."""
        total = np.zeros(len(self.features))
        for t in range(self.n_trees):
            gain = np.zeros(len(self.features))
            for (tree, _), (f, _, g) in self.splits.items():
                if tree == t:
                    gain[f] += g
            total += gain / gain.sum() if gain.sum() > 0 else 0
        return dict(zip(self.features, (total / total.sum() if total.sum() > 0 else total).tolist()))


def _width(model: Forest) -> int:
    return max([n for _, n in model.nodes], default=ROOT) + 1


def _tables(model: Forest):
    feature = np.full((model.n_trees, _width(model)), -1, dtype=np.int64)
    cut = np.zeros(feature.shape)
    for (t, n), (f, c, _) in model.splits.items():
        feature[t, n], cut[t, n] = f, c
    return feature, cut


def _means(model: Forest):
    value = np.full((model.n_trees, _width(model)), np.nan)
    for (t, n), (rows, total) in model.nodes.items():
        value[t, n] = total / rows if rows else np.nan
    return value


def _descend(rows: pd.Series, feature: np.ndarray, cut: np.ndarray):
    """The node that each tree puts each row in, 1,024 rows at a time."""
    trees = np.arange(feature.shape[0])[None, :]
    for at in range(0, len(rows), 1024):
        x = np.stack([np.array(r, dtype=np.float64) for r in rows[at: at + 1024]])
        node = np.ones((x.shape[0], feature.shape[0]), dtype=np.int64)
        while True:
            f = feature[trees, np.minimum(node, feature.shape[1] - 1)]
            inner = (f >= 0) & (node < feature.shape[1])
            if not inner.any():
                break
            v = np.take_along_axis(x, np.maximum(f, 0), axis=1)
            right = ~(v <= cut[trees, np.minimum(node, feature.shape[1] - 1)])
            node = np.where(inner, 2 * node + right, node)
        yield node


def _slices(batches, n_trees: int, whole: bool = False):
    """Labels, features, weights and ranges of up to ``SLICE_BYTES`` of weights; ``whole``: of one
    range each, those of a single value left out. Missing and NaN feature values become infinite;
    + 0.0 makes -0.0 and 0.0 one value."""
    held, size, last = [], 0, None
    for batch in batches:
        if batch.column("w").null_count:
            batch = batch.filter(batch.column("w").is_valid())
        if batch.num_rows == 0:
            continue
        y = batch.column("y").to_numpy(zero_copy_only=False)
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
        w = batch.column("w").flatten().to_numpy(zero_copy_only=False).reshape(len(y), n_trees)
        part = batch.column("part").to_numpy(zero_copy_only=False) if "part" in batch.schema.names else np.zeros(len(y), np.int32)
        borders = np.flatnonzero(part[1:] != part[:-1]) + 1 if whole else []
        for a, b in zip([0, *borders], [*borders, len(y)]):
            if whole and held and last != part[a]:
                yield [np.concatenate(c) for c in zip(*held)]
                held, size = [], 0
            last = part[a]
            if whole and last % 2 == 0:
                continue
            held.append((y[a:b], np.where(np.isnan(x[a:b]), np.inf, x[a:b] + 0.0), w[a:b].copy(), part[a:b]))
            size += held[-1][2].nbytes
        if size >= SLICE_BYTES and not whole:
            yield [np.concatenate(c) for c in zip(*held)]
            held, size = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _open(model: Forest, depth: int, looked: dict | None, long: int | None = None) -> list:
    """Per tree its splits and the nodes that a task goes through on the way to those of ``depth``
    (none: all); ``long``: to those that look at this feature."""
    splits = [{} for _ in range(model.n_trees)]
    for (t, v), (f, cut, _) in model.splits.items():
        splits[t][v] = (f, cut)
    on = None
    if looked and long is not None:
        on = [set() for _ in range(model.n_trees)]
        for (t, v), features in looked.items():
            if long in features:
                on[t].update(v >> up for up in range(depth + 1))
    return [(splits[t], None if on is None else on[t]) for t in range(model.n_trees)]


def _members(x: np.ndarray, w: np.ndarray, trees: list, depth: int):
    """(tree, its nodes at ``depth`` with their rows, its weights); rows stay in their order."""
    columns, drawn = np.ascontiguousarray(x.T), np.ascontiguousarray(w.T)
    for t, (splits, on) in enumerate(trees):
        if on is not None and ROOT not in on:
            continue
        nodes = [(ROOT, np.flatnonzero(drawn[t] > 0))]
        for _ in range(depth):
            below = []
            for v, rows in nodes:
                if v not in splits:
                    continue
                f, cut = splits[v]
                left = columns[f].take(rows) <= cut
                below += [(c, rows[side]) for c, side in ((2 * v, left), (2 * v + 1, ~left)) if on is None or c in on]
            nodes = below
        nodes = [(v, rows) for v, rows in nodes if len(rows)]
        if nodes:
            yield t, nodes, drawn[t]


def _batch(cells: list, names: list[str]) -> pa.RecordBatch:
    """Cells as a batch: tree and node are numbers, the rest arrays of one length."""
    keys = [np.repeat(np.array([c[i] for c in cells], np.int32), [len(c[2]) for c in cells]) for i in range(2)]
    return pa.RecordBatch.from_arrays([pa.array(k) for k in keys] + [
        pa.array(np.concatenate([c[i] for c in cells])) for i in range(2, len(names))], names=names)


def _coded(x: np.ndarray, long: tuple):
    """All features' values in one row, the feature of each, where a feature begins (and the last
    ends), and a row of places in it for each feature; ``long`` features have none."""
    found = [(np.zeros(0), np.zeros(len(x), np.int64)) if f in long else np.unique(x[:, f], return_inverse=True) for f in range(x.shape[1])]
    sizes = np.array([len(v) for v, _ in found], np.int64)
    values = np.concatenate([v for v, _ in found]) if found else np.zeros(0)
    return values, np.repeat(np.arange(len(found), dtype=np.int32), sizes), np.r_[0, sizes.cumsum()], np.concatenate([c for _, c in found])


def _sums(model: Forest, depth: int, looked: dict | None, long: tuple = ()):
    """Rows of a task -> sums per (tree, node, feature, value) of its slices, ``long`` features left
    out; without ``looked`` per (tree, node), as feature -1."""
    trees = _open(model, depth, looked)
    every = np.array([f for f in range(len(model.features)) if f not in long], np.int64)
    own = {at: np.array([f for f in some if f not in long], np.int64) for at, some in (looked or {}).items()}
    names = ["tree", "node", "feature", "value", "n", "s", "q"]
    none = np.full(1, -1, np.int32)

    def run(batches):
        out, held = [], 0
        for y, x, w, _ in _slices(batches, model.n_trees):
            binary = bool(((y == 0) | (y == 1)).all())
            if looked is not None:
                values, features, begin, places = _coded(x, long)
            for t, nodes, drawn in _members(x, w, trees, depth):
                for v, part in nodes:
                    n = drawn.take(part).astype(np.float64)
                    s = n * y.take(part)
                    q = s if binary else s * y.take(part)
                    if looked is None:
                        out.append((t, v, none, np.zeros(1), np.array([n.sum()]), np.array([s.sum()]), np.array([q.sum()])))
                        held += 1
                        continue
                    some = own.get((t, v), every)
                    if len(some) == 0:
                        continue
                    sizes = begin[some + 1] - begin[some]
                    upto = sizes.cumsum()  # the features' places one after the other
                    code = (places.take(part + len(y) * some[:, None]) + (upto - sizes)[:, None]).ravel()
                    cells = (np.arange(upto[-1]) + np.repeat(begin[some] - upto + sizes, sizes)) if len(some) < len(begin) - 1 else np.arange(upto[-1])
                    if len(cells) > len(code):  # sums over the values that occur here only
                        here, code = np.unique(code, return_inverse=True)
                        cells = cells[here]
                    if binary:
                        cn = np.bincount(2 * code + np.tile(y.take(part).astype(np.int64), len(some)), np.tile(n, len(some)), 2 * len(cells))
                        cn, cs = cn[::2] + cn[1::2], cn[1::2]
                        cq = cs
                    else:
                        cn, cs, cq = (np.bincount(code, np.tile(c, len(some)), len(cells)) for c in (n, s, q))
                    at = np.flatnonzero(cn)
                    cells = cells.take(at)
                    out.append((t, v, features.take(cells), values.take(cells), cn.take(at), cs.take(at), cq.take(at)))
                    held += len(cells)
                if held >= 100_000:
                    yield _batch(out, names)
                    out, held = [], 0
        if out:
            yield _batch(out, names)

    return run


def _range_sums(model: Forest, depth: int, looked: dict, f: int):
    """Rows in the order of (range, value) -> sums and lowest value per (tree, node, range)."""
    trees, names = _open(model, depth, looked, f), ["tree", "node", "feature", "part", "n", "s", "q", "low"]

    def run(batches):
        for y, x, w, ranges in _slices(batches, model.n_trees):
            out = []
            for t, nodes, drawn in _members(x, w, trees, depth):
                for v, part in nodes:
                    n, of, label = drawn.take(part).astype(np.float64), ranges.take(part), y.take(part)
                    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                    out.append((t, v, np.full(len(first), f, np.int32), of[first], np.add.reduceat(n, first), np.add.reduceat(n * label, first),
                                np.add.reduceat(n * label * label, first), x[part[first], f]))
            if out:
                yield _batch(out, names)

    return run


def _scores(nl, sl, nt, st, qt, value, above, min_leaf: float):
    """The criterion of each candidate (-inf: none) and its threshold, as in ``_best_splits``."""
    nr, sr = nt - nl, st - sl
    fits = ~np.isnan(above) & (nl >= min_leaf) & (nr >= min_leaf) & (nt * qt > st * st)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(fits, sl * sl / nl + sr * sr / nr, -np.inf), np.where(above == np.inf, value, (value + above) / 2)


def _range_best(model: Forest, depth: int, looked: dict, f: int, before: dict, min_leaf: float):
    """Rows in the order of (range, value) -> the best candidate per (tree, node) in the task's ranges.
    ``before[tree, node]``: the ranges, their n and s before, next value above, and n, s, q of the node."""
    trees, names = _open(model, depth, looked, f), ["tree", "node", "feature", "minus", "value", "cut", "nl", "sl"]

    def run(batches):
        best = {}
        for y, x, w, ranges in _slices(batches, model.n_trees, whole=True):
            for t, nodes, drawn in _members(x, w, trees, depth):
                for v, part in nodes:
                    of, n0, s0, above, nt, st, qt = before[t, v]
                    if not nt * qt > st * st:
                        continue
                    at = np.searchsorted(of, ranges[0])
                    n, value = drawn.take(part).astype(np.float64), x[part, f]
                    last = np.flatnonzero(np.r_[value[1:] != value[:-1], True])
                    nl, sl = n0[at] + n.cumsum()[last], s0[at] + (n * y.take(part)).cumsum()[last]
                    value = value[last]
                    score, cut = _scores(nl, sl, nt, st, qt, value, np.r_[value[1:], above[at]], min_leaf)
                    i = int(score.argmax())  # the first of the best: the lowest value
                    found = (-score[i], f, value[i], cut[i], nl[i], sl[i])
                    if score[i] > -np.inf and found < best.get((t, v), (np.inf,)):
                        best[t, v] = found
        if best:
            rows = [(t, v, np.array([f], np.int32), *(np.array([b[i]]) for i in (0, 2, 3, 4, 5))) for (t, v), b in best.items()]
            yield _batch(rows, names)

    return run


def _best_of_ranges(data: DataFrame, model: Forest, depth: int, looked: dict, f: int, min_leaf: float) -> dict:
    """(tree, node) -> its n, s and best candidate of a feature whose rows are dealt by ranges."""
    sums = data.mapInArrow(_range_sums(model, depth, looked, f), RANGES).groupBy("tree", "node", "part").agg(
        *[F.sum(c).alias(c) for c in ("n", "s", "q")], F.min("low").alias("low")).toPandas().sort_values(["tree", "node", "part"])
    if len(sums) == 0:
        return {}
    tree, node, part, n, s, q, low = (sums[c].to_numpy() for c in ("tree", "node", "part", "n", "s", "q", "low"))
    first = np.flatnonzero(np.r_[True, (tree[1:] != tree[:-1]) | (node[1:] != node[:-1])])
    before, out = {}, {}
    for a, b in zip(first, np.r_[first[1:], len(tree)]):
        at, upto, sums_upto = (int(tree[a]), int(node[a])), n[a:b].cumsum(), s[a:b].cumsum()
        nt, st, qt, above = upto[-1], sums_upto[-1], q[a:b].sum(), np.r_[low[a + 1: b], np.nan]
        before[at] = (part[a:b], upto - n[a:b], sums_upto - s[a:b], above, nt, st, qt)
        score, cut = _scores(upto, sums_upto, nt, st, qt, low[a:b], above, min_leaf)
        score[part[a:b] % 2 == 1] = -np.inf  # ranges of one value are settled here
        i = int(score.argmax())
        out[at] = (nt, st, (-score[i], f, low[a:b][i], cut[i], upto[i], sums_upto[i]) if score[i] > -np.inf else None)
    found = data.mapInArrow(_range_best(model, depth, looked, f, before, min_leaf), RANGE_BEST).groupBy("tree", "node").agg(
        F.min(F.struct("minus", "feature", "value", "cut", "nl", "sl")).alias("best")).collect()
    for r in found:
        nt, st, best = out[r["tree"], r["node"]]
        b = tuple(r["best"])
        out[r["tree"], r["node"]] = (nt, st, b if best is None or b < best else best)
    return out


def poisson_cuts(most: int = 12) -> list[int]:
    """Borders on the hash's range: the weight of a row is the number of borders at or below its
    hash, which makes it a Poisson(1) draw (weights above ``most`` are below one in 10^9)."""
    below, out = 0.0, []
    for k in range(most):
        below += math.exp(-1) / math.factorial(k)
        out.append(min(int(below * HASH_SPAN), HASH_SPAN - 1))
    return out


def bootstrap_weights(id_col: str, n_trees: int, seed: int) -> Column:
    """Array over the trees of the row's Poisson(1) weights, drawn from the 60-bit hash
    ``md5('<seed * 100000 + tree>:<id>')`` (see ``ml.hash_key``)."""
    cuts = poisson_cuts()
    keys = F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda tree: F.substring(F.md5(F.concat(
        (F.lit(seed * 100_000) + tree).cast("string"), F.lit(":"), F.col(id_col).cast("string"))), 1, 15))

    def weight(key: Column) -> Column:  # keys and borders as 15 hexadecimal digits, which sort as their numbers do
        drawn = F.when(key.isNull(), F.lit(None))
        for k, c in enumerate(cuts):
            drawn = drawn.when(key < F.lit(f"{c:015x}"), F.lit(k))
        return drawn.otherwise(F.lit(len(cuts))).cast("tinyint")
    return F.transform(keys, weight)


def _subset(seed: int, tree: int, node: int, n: int, keep: int) -> list[int]:
    """The features that a node looks at: the first of an md5 order."""
    order = sorted(range(n), key=lambda f: hashlib.md5(f"{seed}:{tree}:{node}:{f}".encode()).hexdigest())
    return sorted(order[:keep])


def _sides_by_buckets(cells: DataFrame, by: list[str], bound: int) -> DataFrame:
    """Each cell with the sums up to it and the next value, by running sums in value buckets."""
    rows = ranking.bucketed(cells, "value", by, bound=bound)
    totals = rows.groupBy("_bucket", *by).agg(F.sum("n").alias("bn"), F.sum("s").alias("bs"), F.sum("q").alias("bq"),
                                              F.min("value").alias("low"))
    whole = Window.partitionBy(*by)
    upto = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = totals.select(
        "_bucket", *by, (F.sum("bn").over(upto) - F.col("bn")).alias("n0"), (F.sum("bs").over(upto) - F.col("bs")).alias("s0"),
        F.sum("bn").over(whole).alias("nt"), F.sum("bs").over(whole).alias("st"), F.sum("bq").over(whole).alias("qt"),
        F.lead("low").over(whole.orderBy("_bucket")).alias("next_low"))
    own = Window.partitionBy("_bucket", *by).orderBy("value")
    run = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.join(totals, ["_bucket", *by]).select(
        *by, "value", "nt", "st", "qt", (F.col("n0") + F.sum("n").over(run)).alias("nl"),
        (F.col("s0") + F.sum("s").over(run)).alias("sl"),
        F.coalesce(F.lead("value").over(own), "next_low").alias("above"))


def _best_splits(cells: DataFrame, min_leaf: float, bound: int) -> DataFrame:
    """Per (tree, node) its rows, label sum, square sum and the best candidate. ``cells`` has one
    row per (tree, node, feature, value): n, s, q."""
    by = ["tree", "node", "feature"]
    if bound >= LONG:  # no feature has more cells in a node
        whole = Window.partitionBy(*by)
        run = whole.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sides = cells.select(
            *by, "value", *[F.sum(c).over(whole).alias(f"{c}t") for c in ("n", "s", "q")], F.sum("n").over(run).alias("nl"),
            F.sum("s").over(run).alias("sl"), F.lead("value").over(whole.orderBy("value")).alias("above"))
    else:
        sides = _sides_by_buckets(cells, by, bound)
    nl, sl = F.col("nl"), F.col("sl")
    nr, sr = F.col("nt") - nl, F.col("st") - sl
    fits = F.col("above").isNotNull() & (nl >= min_leaf) & (nr >= min_leaf) & (F.col("nt") * F.col("qt") > F.col("st") * F.col("st"))
    score = F.when(fits, sl * sl / nl + sr * sr / nr)
    found = F.min(F.when(fits, F.struct(
        (-score).alias("minus"), "feature", "value",
        F.when(F.col("above") == math.inf, F.col("value")).otherwise((F.col("value") + F.col("above")) / 2).alias("cut"), nl.alias("nl"), sl.alias("sl"))))
    return sides.groupBy("tree", "node").agg(F.first("nt").alias("n"), F.first("st").alias("s"), found.alias("best"))


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over all cores, whatever their bytes: many trees make much work of a small table."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def grow(df: DataFrame, features: list[str], weights: Column | None = None, n_trees: int = 1, label: str = "label",
         features_col: str = "features", max_depth: int = 2, min_leaf: float = 1, per_node: int | None = None,
         seed: int = 0, bound: int = ranking.TASK_ROWS) -> Forest:
    """Grow ``n_trees`` trees together, one pass over ``df`` a level, after its rows are dealt over the cores.

    ``features_col`` is an array of doubles in the order of ``features``; ``weights`` an array over
    the trees (none: weight 1 in each). ``per_node`` features, drawn by a hash of (tree, node), are
    looked at in a node (none: all). Weights and 0/1 or whole-number labels are summed exactly."""
    ones = F.array(*[F.lit(1).cast("tinyint")] * n_trees)
    x = F.col(features_col).cast("array<double>")
    rows = spread(df).filter(F.col(label).cast("double").isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)
    columns = [F.col(label).cast("double").alias("y"), x.alias("x"), (ones if weights is None else weights).alias("w")]
    model = Forest(list(features), n_trees)
    open_nodes = [(t, ROOT) for t in range(n_trees)]
    by = ["tree", "node", "feature", "value"]
    sums = [F.sum(c).alias(c) for c in ("n", "s", "q")]
    kept = [rows]
    try:
        long = {f: _by_ranges(rows, x, f, quantiles).select(*columns, "part").persist(StorageLevel.MEMORY_AND_DISK)
                for f, quantiles in _long(rows, x, n_trees, len(features)).items()}
        data = next(iter(long.values())) if long else rows.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
        kept += [*long.values()] or [data]
        for depth in range(max_depth + 1):
            if not open_nodes:
                break
            if depth == max_depth:  # leaves of the last level only need their means
                found = data.mapInArrow(_sums(model, depth, None), CELLS).groupBy("tree", "node").agg(*sums[:2]).collect()
                model.nodes.update({(r["tree"], r["node"]): (r["n"], r["s"]) for r in found})
                break
            looked = {} if per_node is None or per_node >= len(features) else {
                (t, v): _subset(seed, t, v, len(features), per_node) for t, v in open_nodes}
            best = {}
            if len(long) < len(features):
                cells = data.mapInArrow(_sums(model, depth, looked, tuple(long)), CELLS).groupBy(*by).agg(*sums).persist(StorageLevel.MEMORY_AND_DISK)
                for r in _best_splits(cells, min_leaf, bound).collect():
                    best[r["tree"], r["node"]] = (r["n"], r["s"], None if r["best"] is None else tuple(r["best"]))
                cells.unpersist()
            for f, dealt in long.items():
                for at, (n, s, b) in _best_of_ranges(dealt, model, depth, looked, f, min_leaf).items():
                    own = best.get(at, (n, s, None))
                    best[at] = (*own[:2], min((c for c in (own[2], b) if c is not None), default=None))
            open_nodes = []
            for (t, v), (n, s, b) in best.items():
                model.nodes[t, v] = (float(n), float(s))
                if b is None:
                    continue
                minus, f, _, cut, nl, sl = b
                model.splits[t, v] = (int(f), float(cut), float(-minus - s * s / n))
                for child, cn, cs in ((2 * v, nl, sl), (2 * v + 1, n - nl, s - sl)):
                    model.nodes[t, child] = (float(cn), float(cs))
                    open_nodes.append((t, child))
    finally:
        for frame in kept:
            frame.unpersist()
    return model


def _long(rows: DataFrame, x: Column, n_trees: int, n_features: int) -> dict:
    """The features with more than ``LONG`` distinct values -> quantiles, the borders between
    their ranges; a common value is several of them."""
    if n_features == 0:
        return {}

    def distinct(batches):  # of a task, more than enough of them
        held = [np.zeros(0)] * n_features
        for batch in batches:
            values = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            held = [np.unique(np.r_[h, np.where(np.isnan(v), np.inf, v + 0.0)]) if len(h) <= LONG else h for h, v in zip(held, values.T)]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(n_features, dtype=np.int32), [len(h) for h in held])),
                                          pa.array(np.concatenate(held))], names=["feature", "value"])

    of = rows.select(x.alias("x")).mapInArrow(distinct, "feature int, value double").distinct().groupBy("feature").count()
    found = sorted(r["feature"] for r in of.filter(F.col("count") > LONG).collect())
    if not found:
        return {}
    n = rows.count()
    ranges = max(4 * rows.sparkSession.sparkContext.defaultParallelism, math.ceil(2 * n * n_trees / SLICE_BYTES))
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    borders = rows.agg(*[F.percentile_approx(F.when(~F.isnan(x[f]), x[f]), shares, 100 * ranges).alias(f"_{f}") for f in found]).first()
    return {f: sorted(v + 0.0 for v in borders[f"_{f}"] or [] if abs(v) < math.inf) for f in found}


def _by_ranges(rows: DataFrame, x: Column, f: int, quantiles: list[float]) -> DataFrame:
    """Rows dealt and sorted by ``part``, the range of the feature's value: 2p is the p-th border itself,
    2p + 1 the values above it, -1 those below the first. Rows of a common value are dealt further, by a hash of the row."""
    value = F.when(x[f].isNull() | F.isnan(x[f]), F.lit(math.inf)).otherwise(x[f] + F.lit(0.0))
    borders = sorted(set(quantiles))
    at, common = np.array(borders), {2 * p: quantiles.count(b) for p, b in enumerate(borders) if quantiles.count(b) > 1}

    @F.pandas_udf("int")
    def part(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(at, values, "left") + np.searchsorted(at, values, "right") - 1, dtype="int32")

    slots = F.coalesce(F.element_at(F.create_map(*[F.lit(v) for c in common.items() for v in c]), F.col("part")), F.lit(1)) if common else F.lit(1)
    hashed = [F.col(quoted(c.name)) for c in rows.schema if not isinstance(c.dataType, T.MapType)]
    dealt = rows.withColumn("_value", value).withColumn("part", part("_value")).withColumn(
        "_slot", F.floor((F.col("part") + 3) / 2).cast("int") + F.pmod(F.xxhash64(*hashed), slots).cast("int"))
    parts = len(quantiles) + 1
    by_hash = rows.sparkSession.range(32 * parts).select(F.pmod(F.hash("id"), F.lit(parts)).alias("to"), "id").collect()
    key = {r["to"]: r["id"] for r in by_hash}  # a key that Spark deals to each partition, so that ranges don't share one
    keys = F.array(*[F.lit(key.get(i, i)).cast("long") for i in range(parts)])
    return dealt.repartition(parts, F.element_at(keys, F.pmod("_slot", F.lit(parts)) + 1)).sortWithinPartitions("part", "_value")
