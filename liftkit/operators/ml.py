"""Feature preparation, splits and models.

Splits are deterministic functions of the row id (stable under repartitioning and executor
loss, unlike ``randomSplit``). Scalers are fitted as one-row aggregates on the training rows
and applied as scalar subqueries. The exact k-nearest-neighbour classifier visits metric cells with
``cogroup().applyInPandas``; the Spark ML estimators stay for callers who want binned trees.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftkit.functions.clean import quoted
from liftkit.operators import ranking
from liftkit.sources import files

# -- splits -----------------------------------------------------------------------------------


HASH_SPAN = 16 ** 15  # md5-derived keys are 60-bit integers in [0, HASH_SPAN)


def hash_key(id_col: str, seed: int) -> Column:
    """60-bit integer from md5('<seed>:<id>'): uniform, deterministic, stable under
    repartitioning and recomputation, and computable the same way in other SQL engines."""
    text = F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def split_hash(df: DataFrame, id_col: str, test_fraction: float = 0.25, seed: int = 42) -> DataFrame:
    """Add ``split`` = 'test' for a deterministic ``test_fraction`` of ids, else 'train'."""
    cut = int(test_fraction * HASH_SPAN)
    return df.withColumn("split", F.when(hash_key(id_col, seed) < F.lit(cut), F.lit("test")).otherwise(F.lit("train")))


def fold_of(id_col: str, folds: int, seed: int) -> Column:
    """Fold number 0..folds-1 from the id hash (equal-width slices of the hash range)."""
    return (hash_key(id_col, seed) / F.lit(float(HASH_SPAN)) * folds).cast("int")


def positions(df: DataFrame, order_col: str, group_col: str | None = None, name: str = "position") -> DataFrame:
    """0-based position of each row in ``order_col`` order (within ``group_col``), exact and
    distributed (``ranking.ordered_offsets``); rows tied in ``order_col`` follow each other."""
    out = ranking.ordered_offsets(df, order_col, [group_col] if group_col else [])
    return out.withColumnRenamed("_before", name).drop("_n")


def split_stratified(df: DataFrame, id_col: str, label_col: str, test_fraction: float = 0.25,
                     seed: int = 0) -> DataFrame:
    """Exact stratified split: within each label, the first round(fraction x n) rows in id-hash
    order are 'test'. A label's size comes with its buckets' offsets (a label of any size is
    spread over the buckets of the hash)."""
    ranked = ranking.ordered_offsets(df.withColumn("_h", hash_key(id_col, seed)), "_h", [label_col])
    n_test = F.round(F.col("_n") * test_fraction)
    return ranked.withColumn("split", F.when(F.col("_before") < n_test, F.lit("test")).otherwise(F.lit("train"))).drop(
        "_h", "_before", "_n")


# -- scalers ------------------------------------------------------------------------------------


def fit_minmax(df: DataFrame, cols: list[str]) -> dict:
    """Fitted min and max per column: one aggregate pass, one small row kept as model state."""
    row = df.agg(*[F.min(quoted(c)).alias(f"{c}__min") for c in cols], *[F.max(quoted(c)).alias(f"{c}__max") for c in cols]).first()
    return {c: (row[f"{c}__min"], row[f"{c}__max"]) for c in cols}


def apply_minmax(df: DataFrame, stats: dict, cols: list[str]) -> DataFrame:
    """(x - min) / (max - min); a constant column maps to 0."""
    out = {}
    for c in cols:
        lo, hi = stats[c]
        if lo is None or hi is None or not hi > lo:
            out[c] = F.when(F.col(quoted(c)).isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
        else:
            out[c] = (F.col(quoted(c)) - F.lit(float(lo))) / F.lit(float(hi - lo))
    return df.withColumns(out)


def minmax_scale(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    return apply_minmax(df, fit_minmax(fit_on if fit_on is not None else df, cols), cols)


def fit_standard(df: DataFrame, cols: list[str]) -> dict:
    """Fitted mean and population standard deviation per column (one aggregate pass)."""
    row = df.agg(*[F.avg(quoted(c)).alias(f"{c}__mean") for c in cols], *[F.stddev_pop(quoted(c)).alias(f"{c}__sd") for c in cols]).first()
    return {c: (row[f"{c}__mean"], row[f"{c}__sd"]) for c in cols}


def apply_standard(df: DataFrame, stats: dict, cols: list[str]) -> DataFrame:
    """(x - mean) / population sd; a constant column maps to 0."""
    out = {}
    for c in cols:
        mu, sd = stats[c]
        if mu is None or sd is None or not sd > 0:
            out[c] = F.when(F.col(quoted(c)).isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
        else:
            out[c] = (F.col(quoted(c)) - F.lit(float(mu))) / F.lit(float(sd))
    return df.withColumns(out)


def standardize(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    return apply_standard(df, fit_standard(fit_on if fit_on is not None else df, cols), cols)


# -- one-hot ------------------------------------------------------------------------------------


def category_levels(df: DataFrame, col: str) -> list:
    """Sorted distinct non-missing levels of a column (model state: one value a level)."""
    c = F.col(quoted(col))
    return sorted(r[0] for r in df.select(c).filter(c.isNotNull()).distinct().collect())


def onehot(df: DataFrame, columns: list[str], prefixes: list[str], max_levels: int | None = None) -> DataFrame:
    """Wide one-hot: a 0/1 column ``<prefix>_<level>`` per level, every level kept, missing
    -> all zeros; the source column is dropped. The form is the caller's choice: wide whatever
    the number of levels, unless ``max_levels`` is given, which asks for one sparse vector
    column ``<prefix>_vec`` in place of more columns than that. ``onehot_coordinates`` has no
    limit of width."""
    out = df
    for col, prefix in zip(columns, prefixes):
        source = F.col(quoted(col))
        if max_levels is not None and df.select(source).filter(source.isNotNull()).distinct().limit(max_levels + 1).count() > max_levels:
            out = onehot_vector(df, [col]).fit(df).transform(out).withColumnRenamed(f"{col}__vec", f"{prefix}_vec").drop(
                f"{col}__idx", col)
            continue
        out = out.withColumns({
            f"{prefix}_{lv}": F.coalesce((source == F.lit(lv)).cast("int"), F.lit(0)) for lv in category_levels(df, col)}).drop(col)
    return out


def onehot_coordinates(df: DataFrame, id_col: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """One-hot as the places of its ones, for any number of levels: ``(id, slot)`` rows, and
    the ``(column, level, slot)`` table. Slots count from 0 by column, then level (as text);
    missing values have no row. No level reaches the driver."""
    pairs = [F.struct(F.lit(i).alias("_c"), F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("level"))
             for i, c in enumerate(columns)]
    cells = df.select(F.col(quoted(id_col)).alias("id"), F.explode(F.array(*pairs)).alias("_cell")).select("id", "_cell.*").filter(
        F.col("level").isNotNull())
    levels = cells.select("_c", "column", "level").distinct()
    levels = levels.withColumn("_order", F.concat(F.lpad(F.col("_c").cast("string"), 6, "0"), F.lit(":"), "level"))
    levels = ranking.ordered_offsets(levels, "_order").select("column", "level", F.col("_before").alias("slot"))
    return cells.join(levels, ["column", "level"]).select("id", "slot"), levels


def onehot_vector(df: DataFrame, columns: list[str]) -> Pipeline:
    """Sparse alternative for high-cardinality columns: StringIndexer + OneHotEncoder with
    every level kept; missing values (the last index) are the level dropped: all zeros."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    stages = []
    for c in columns:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__vec", dropLast=True))
    return Pipeline(stages=stages)


# -- exact k nearest neighbours ---------------------------------------------------------------------


KNN_CELLS = 1 << 19   # distances that a task holds at once
KNN_VISITS = 1 << 13  # visits, each with its query's vector, that a task puts out at once
KNN_FOUND = "qid long, qvec array<double>, tids array<long>, tlabels array<long>, dists array<double>"
KNN_BLOCK = "cell int, part int, tids binary, tlabels binary, tvecs binary"
KNN_GROUP = "home int, first int, qids binary, qvecs binary, bounds binary, at array<long>"
KNN_PAIRS = 1 << 16  # pairs that a task takes exact distances of at once
KNN_BATCH = 16 << 20  # bytes of vectors that go to Python at once, at least one block and one group


def _cell_topk(k: int):
    """(queries, training rows) of one cell -> each query's k nearest in it, as one row. The
    expanded squares choose, differences give the distances, ties at the k-th place included."""
    def run(key, q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0:
            return pd.DataFrame({"qid": [], "qvec": [], "tids": [], "tlabels": [], "dists": []}, dtype=object)
        qm = np.stack(q["qvec"].to_numpy()).astype(np.float64)
        out = []
        if len(t) == 0:
            out = [([], [], [])] * len(q)
        else:
            tm = np.stack(t["tvec"].to_numpy()).astype(np.float64)
            tid, tlabel = t["tid"].to_numpy(np.int64), t["tlabel"].to_numpy(np.int64)
            q2, t2 = (qm * qm).sum(1), (tm * tm).sum(1)
            kk, step = min(k, len(tm)), max(1, KNN_CELLS // len(tm))
            for at in range(0, len(qm), step):
                sizes = q2[at: at + step, None] + t2[None, :]
                d2 = sizes - 2.0 * (qm[at: at + step] @ tm.T)
                kth = np.partition(d2, kk - 1, axis=1)[:, kk - 1]
                for i in range(len(d2)):
                    near = np.flatnonzero(d2[i] <= kth[i] + 1e-12 * (1.0 + sizes[i].max()))
                    dist = np.sqrt(((tm[near] - qm[at + i]) ** 2).sum(1))
                    first = np.lexsort((tid[near], dist))[:k]
                    out.append((tid[near][first], tlabel[near][first], dist[first]))
        return pd.DataFrame({"qid": q["qid"].to_numpy(), "qvec": list(qm), "tids": [o[0] for o in out],
                             "tlabels": [o[1] for o in out], "dists": [o[2] for o in out]})

    return run


def _to_pivots(pivots: np.ndarray, prefix: str):
    """Adds each row's nearest pivot (``cell``) and the distance to it (``away``)."""
    vec = f"{prefix}vec"

    def run(batches):
        for rows in batches:
            if len(rows) == 0:
                continue
            x = np.stack(rows[vec].to_numpy()).astype(np.float64)
            cell, away, step = np.zeros(len(x), "int32"), np.zeros(len(x)), max(1, KNN_CELLS // len(pivots))
            for at in range(0, len(x), step):
                d = np.stack([np.sqrt(((x[at: at + step] - p) ** 2).sum(1)) for p in pivots], axis=1)
                cell[at: at + step], away[at: at + step] = d.argmin(axis=1), d.min(axis=1)
            rows["cell"], rows["away"] = cell, away
            yield rows
    return run


def _cells_to_visit(pivots: np.ndarray, cells: list[tuple], k: int):
    """The blocks that may hold one of a query's k nearest rows, its first block left out. The
    k-th distance is at most that in the first block, and at most d + radius of the cells that hold
    k rows when taken by d + radius. Visits are put out by ``KNN_VISITS``, however many a query has."""
    which = np.array([c[0] for c in cells])
    low, high = np.array([c[1] for c in cells]), np.array([c[2] for c in cells])
    parts, rows_in = [c[3] for c in cells], np.array([c[4] for c in cells])

    def made(qid, qvec, cell, part):
        return pd.DataFrame({"qid": qid, "qvec": qvec, "cell": np.array(cell, "int32"), "part": np.array(part, "int32")})

    def run(batches):
        for rows in batches:
            qid, qvec, cell, part = [], [], [], []
            for i, v, dists, home, first in zip(rows["qid"], rows["qvec"], rows["dists"], rows["cell"], rows["part"]):
                bound = dists[k - 1] if len(dists) >= k else np.inf
                d = np.sqrt(((pivots[which] - v) ** 2).sum(1))
                reach = np.argsort(d + high)
                held = np.searchsorted(rows_in[reach].cumsum(), k)
                if held < len(reach):
                    bound = min(bound, (d + high)[reach[held]])
                slack = 1e-9 * (1.0 + d)
                for c in np.flatnonzero((d - high <= bound + slack) & (low - d <= bound + slack)):
                    for p in range(parts[c]):
                        if which[c] != home or p != first:
                            qid.append(i), qvec.append(v), cell.append(which[c]), part.append(p)
                            if len(qid) >= KNN_VISITS:
                                yield made(qid, qvec, cell, part)
                                qid, qvec, cell, part = [], [], [], []
            if qid:
                yield made(qid, qvec, cell, part)
    return run


def knn_cells(train: DataFrame, query: DataFrame, k: int, id_col: str, vec_col: str, label_col: str,
              block_rows: int = 4096, max_pivots: int = 1024) -> tuple[DataFrame, DataFrame | None, DataFrame, dict]:
    """The steps of ``knn_neighbours``: (found in the first block, further visits or None if there
    is one block only, training rows by block, rows per cell)."""
    found, blocks, cells, pivots = _first_blocks(train, query, k, id_col, vec_col, label_col, block_rows, max_pivots)
    visits = None
    if sum(c[3] for c in cells) > 1:
        visits = found.mapInPandas(_cells_to_visit(pivots, cells, k), "qid long, qvec array<double>, cell int, part int")
    return found, visits, blocks, {c[0]: c[4] for c in cells}


def _first_blocks(train: DataFrame, query: DataFrame, k: int, id_col: str, vec_col: str, label_col: str, block_rows: int,
                  max_pivots: int) -> tuple[DataFrame, DataFrame, list[tuple], np.ndarray]:
    """Found in the first block (written, if there are more), training rows by block, the cells as
    (number, lowest and highest distance to the pivot, blocks, rows), the pivots."""
    t = train.select(F.col(id_col).cast("long").alias("tid"), F.col(vec_col).cast("array<double>").alias("tvec"),
                     F.col(label_col).cast("long").alias("tlabel")).filter(F.col("tvec").isNotNull())
    q = query.select(F.col(id_col).cast("long").alias("qid"), F.col(vec_col).cast("array<double>").alias("qvec")).filter(
        F.col("qvec").isNotNull())
    n = t.count()
    drawn = t.orderBy(F.xxhash64("tid"), "tid").limit(min(max_pivots, max(1, math.ceil(n / block_rows)))).select("tvec").collect()
    pivots = np.array([r["tvec"] for r in drawn], dtype=np.float64) if drawn else np.zeros((1, 0))
    if not drawn:  # no training rows: one empty cell
        home_t = t.withColumn("cell", F.lit(0)).withColumn("away", F.lit(0.0))
        home_q = q.withColumn("cell", F.lit(0)).withColumn("away", F.lit(0.0))
    else:
        home_t = t.mapInPandas(_to_pivots(pivots, "t"), "tid long, tvec array<double>, tlabel long, cell int, away double")
        home_q = q.mapInPandas(_to_pivots(pivots, "q"), "qid long, qvec array<double>, cell int, away double")
    stats = home_t.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("away").alias("low"), F.max("away").alias("high")).collect()
    sizes = {r["cell"]: r["n"] for r in stats}
    parts = {c: math.ceil(m / block_rows) for c, m in sizes.items()}

    def dealt(rows: DataFrame, key: str) -> DataFrame:  # a cell above block_rows is cut by a hash
        of = F.element_at(F.create_map(*[F.lit(v) for c in parts for v in (c, parts[c])]), F.col("cell")) if parts else F.lit(1)
        return rows.withColumn("part", F.pmod(F.xxhash64(key), F.coalesce(of, F.lit(1))).cast("int"))

    blocks = dealt(home_t, "tid").drop("away")
    starts = dealt(home_q, "qid").drop("away")
    found = _compare(starts, blocks, k, block_rows)
    cells = [(r["cell"], r["low"], r["high"], parts[r["cell"]], r["n"]) for r in stats]
    if sum(parts.values()) > 1:
        path = files.scratch_path(train.sparkSession, "knn_first")
        found.write.parquet(path)
        found = train.sparkSession.read.parquet(path)
    return found, blocks, cells, pivots


def _compare(queries: DataFrame, blocks: DataFrame, k: int, block_rows: int) -> DataFrame:
    """Every query against its block. A block that many queries visit is copied once for each
    ``block_rows`` of them."""
    copies = queries.groupBy("cell", "part").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("copies"))
    slot = F.pmod(F.xxhash64("qid", F.lit(1)), F.col("copies")).cast("int")
    left = queries.join(copies, ["cell", "part"]).withColumn("copy", slot).drop("copies")
    right = blocks.join(copies, ["cell", "part"]).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    keys = ["cell", "part", "copy"]
    topk = _cell_topk(k)

    def run(key, q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        return topk(key, q, t).assign(cell=key[0], part=key[1])

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, f"{KNN_FOUND}, cell int, part int")


def _bounds(pivots: np.ndarray, high: np.ndarray, rows_in: np.ndarray, x: np.ndarray, dists, k: int):
    """Distances of queries to the pivots, and a bound on their k-th distance: as in ``_cells_to_visit``."""
    d = np.stack([np.sqrt(((x - p) ** 2).sum(1)) for p in pivots], axis=1)
    bound = np.array([v[k - 1] if len(v) >= k else np.inf for v in dists])
    reach = np.argsort(d + high, axis=1)
    held = rows_in[reach].cumsum(axis=1) >= k
    far = np.take_along_axis(d + high, reach, axis=1)[np.arange(len(x)), held.argmax(axis=1)]
    return d, np.minimum(bound, np.where(held.any(axis=1), far + 1e-9 * (1.0 + far), np.inf))


def _groups(pivots: np.ndarray, cells: list[tuple], k: int, block_rows: int):
    """Queries that follow each other with one first block -> groups of up to ``block_rows`` in a row
    each, with the blocks (cell << 32 | part) that one of them has to visit."""
    which, low, high, parts, rows_in = (np.array([c[i] for c in cells]) for i in range(5))

    def run(batches):
        for rows in batches:
            home, first = rows["cell"].to_numpy(), rows["part"].to_numpy()
            starts = np.flatnonzero(np.r_[True, (home[1:] != home[:-1]) | (first[1:] != first[:-1])]) if len(rows) else []
            ends = np.r_[starts[1:], len(rows)] if len(rows) else []
            out = []
            for a, b in ((i, min(i + block_rows, e)) for s, e in zip(starts, ends) for i in range(s, e, block_rows)):
                x = np.stack(rows["qvec"].iloc[a:b].to_numpy()).astype(np.float64)
                d, bound = np.zeros((0, len(cells))), np.zeros(0)
                step = max(1, KNN_CELLS // len(cells))
                for at in range(0, len(x), step):
                    more = _bounds(pivots[which], high, rows_in, x[at: at + step], rows["dists"].iloc[a + at: min(a + at + step, b)], k)
                    d, bound = np.concatenate([d, more[0]]), np.r_[bound, more[1]]
                slack = 1e-9 * (1.0 + d)
                near = ((d - high <= bound[:, None] + slack) & (low - d <= bound[:, None] + slack)).any(axis=0)
                at = [int(which[c]) << 32 | p for c in np.flatnonzero(near) for p in range(parts[c]) if which[c] != home[a] or p != first[a]]
                if at:
                    out.append((home[a], first[a], rows["qid"].to_numpy(np.int64)[a:b].tobytes(), x.tobytes(), bound.tobytes(), at))
            if out:
                yield pd.DataFrame(out, columns=["home", "first", "qids", "qvecs", "bounds", "at"])

    return run


def _block(key, t):
    vecs = np.stack(t["tvec"].to_numpy()).astype(np.float64)
    return pd.DataFrame([(key[0], key[1], t["tid"].to_numpy(np.int64).tobytes(), t["tlabel"].to_numpy(np.int64).tobytes(), vecs.tobytes())],
                        columns=["cell", "part", "tids", "tlabels", "tvecs"])


def _nearer(pivots: np.ndarray, cells: list[tuple], k: int):
    """(block, group) pairs -> for each query its up to k nearest rows in the blocks, those beyond its bound
    left out. A task holds the nearest so far of its queries, and a slice of distances at a time."""
    reach = {c[0]: (c[1], c[2]) for c in cells}

    def run(batches):
        state = {}
        for pairs in batches:
            for r in pairs.itertuples(index=False):
                q = np.frombuffer(r.qvecs).reshape(len(r.qids) // 8, -1)
                if r.group not in state:
                    state[r.group] = (np.frombuffer(r.qids, np.int64), np.frombuffer(r.bounds).copy(), np.zeros(0, np.int64), np.zeros(0),
                                      np.zeros(0, np.int64), np.zeros(0, np.int64))
                qid, bound, *best = state[r.group]
                low, high = reach[r.cell]
                d = np.sqrt(((q - pivots[r.cell]) ** 2).sum(1))
                slack = 1e-9 * (1.0 + d)
                rows = np.flatnonzero((d - high <= bound + slack) & (low - d <= bound + slack))
                if len(rows) == 0:
                    continue
                t, tid, tlabel = np.frombuffer(r.tvecs).reshape(len(r.tids) // 8, -1), np.frombuffer(r.tids, np.int64), np.frombuffer(r.tlabels, np.int64)
                t2, step = (t * t).sum(1), max(1, KNN_CELLS // len(t))
                kind = np.float32 if max(t2.max(), (q * q).sum(1).max()) < 1e30 else np.float64
                off = 8 * (t.shape[1] + 2) * np.finfo(kind).eps  # the squares only choose what is looked at closely
                right = np.column_stack([t, -t2 / 2]).astype(kind).T
                more = [[] for _ in best]

                def merged(best: list) -> list:
                    best = [np.concatenate([b, *m]) for b, m in zip(best, more)]
                    order = np.lexsort((best[2], best[1], best[0]))
                    of = best[0][order]
                    place = np.arange(len(of)) - np.searchsorted(of, of)
                    full = order[place == k - 1]
                    bound[best[0][full]] = np.minimum(bound[best[0][full]], best[1][full])
                    for m in more:
                        m.clear()
                    return [c[order[place < k]] for c in best]

                for at in range(0, len(rows), step):
                    some = rows[at: at + step]
                    x, limit = q[some], bound[some]
                    x2 = (x * x).sum(1)
                    most = limit ** 2 * (1.0 + 1e-9) + 1e-9 + off * (x2 + t2.max())
                    left = np.column_stack([x, np.ones(len(x))]).astype(kind)
                    i, j = np.nonzero(left @ right >= ((x2 - most) / 2).astype(kind)[:, None])
                    for a in range(0, len(i), KNN_PAIRS):
                        i_, j_ = i[a: a + KNN_PAIRS], j[a: a + KNN_PAIRS]
                        dist = np.sqrt(((t[j_] - x[i_]) ** 2).sum(1))
                        near = np.flatnonzero(dist <= limit[i_])
                        for m, c in zip(more, (some[i_[near]], dist[near], tid[j_[near]], tlabel[j_[near]])):
                            m.append(c)
                        if sum(map(len, more[0])) > KNN_PAIRS:
                            best = merged(best)
                best = merged(best)
                state[r.group] = (qid, bound, *best)
        for qid, _, of, dist, tid, tlabel in state.values():
            yield pd.DataFrame({"qid": qid[of], "tid": tid, "tlabel": tlabel, "dist": dist})

    return run


def _visited(found: DataFrame, blocks: DataFrame, cells: list[tuple], pivots: np.ndarray, k: int, block_rows: int) -> DataFrame:
    """The rows of other blocks than a query's first that may be among its k nearest.

    Neither vectors nor visits are shuffled: the training rows are written once, a block a row, and
    each task reads all blocks one after the other (``coalesce(1)``, a Cartesian product) against
    groups of queries that it holds. So the disk grows with the rows, however many pairs are compared."""
    spark = found.sparkSession
    path = files.scratch_path(spark, "knn_blocks")
    blocks.groupBy("cell", "part").applyInPandas(_block, KNN_BLOCK).write.parquet(path)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(KNN_BATCH))
    try:
        groups = found.mapInPandas(_groups(pivots, cells, k, block_rows), KNN_GROUP).withColumn("group", F.monotonically_increasing_id())
        left = spark.read.parquet(path).coalesce(1).hint("shuffle_replicate_nl")
        here = F.shiftleft(F.col("cell").cast("long"), 32).bitwiseOR(F.col("part").cast("long"))
        pairs = left.join(groups, F.array_contains("at", here)).select("group", "cell", "tids", "tlabels", "tvecs", "qids", "qvecs", "bounds")
        out = files.scratch_path(spark, "knn_visited")
        pairs.mapInPandas(_nearer(pivots, cells, k), "qid long, tid long, tlabel long, dist double").write.parquet(out)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    return spark.read.parquet(out)


def knn_neighbours(train: DataFrame, query: DataFrame, k: int, id_col: str, vec_col: str, label_col: str,
                   block_rows: int = 4096, max_pivots: int = 1024) -> DataFrame:
    """Exact k nearest training rows for every query row: (qid, tid, tlabel, dist, rank).

    Metric cells: a hash of the id draws one pivot for each ``block_rows`` training rows
    (``max_pivots`` at most), and every row goes to its nearest pivot's cell. A query is first
    compared with a block of its own cell, which bounds its k-th distance; the triangle inequality
    then rules out every cell whose rows all lie farther away, and only the others are visited. A
    cell above ``block_rows`` rows is cut by a hash, a first block of many queries is
    copied per ``block_rows`` of them, so a task compares two bounded sides. The further blocks are read
    by every task one after the other (``_visited``), which copies neither vectors nor visits. How much is ruled out depends on how the vectors cluster; the rows are the same.

    Rows without a vector take no part; ties go to the smaller ``tid``; ids of queries are expected
    to be unique, training ids may repeat; without training rows nothing comes out. First results,
    blocks and later results are written under ``spark.checkpoint.dir``.
    """
    found, blocks, cells, pivots = _first_blocks(train, query, k, id_col, vec_col, label_col, block_rows, max_pivots)
    cand = found.select("qid", F.explode(F.arrays_zip(F.col("tids").alias("tid"), F.col("tlabels").alias("tlabel"),
                                                      F.col("dists").alias("dist"))).alias("at")).select("qid", "at.*")
    if sum(c[3] for c in cells) > 1:
        cand = cand.unionByName(_visited(found, blocks, cells, pivots, k, block_rows))
    w = Window.partitionBy("qid").orderBy("dist", "tid")
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def knn_vote(neighbours: DataFrame, ks: list[int]) -> DataFrame:
    """Majority label among the first k neighbours for each k; ties -> smallest label."""
    exploded = neighbours.withColumn("k", F.explode(F.array(*[F.lit(x) for x in ks]))).filter(F.col("rank") <= F.col("k"))
    votes = exploded.groupBy("qid", "k", "tlabel").agg(F.count(F.lit(1)).alias("votes"))
    w = Window.partitionBy("qid", "k").orderBy(F.col("votes").desc(), F.col("tlabel").asc())
    return votes.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).select(
        "qid", "k", F.col("tlabel").alias("prediction"))


def knn_accuracy_curve(df: DataFrame, id_col: str, vec_col: str, label_col: str, split_col: str = "split",
                       ks: list[int] = tuple(range(1, 11)), block_rows: int = 4096) -> DataFrame:
    """Train and test accuracy of the k-NN classifier for each k (train rows score against
    the training set, themselves included, as a fitted classifier's ``score`` does)."""
    train = df.filter(F.col(split_col) == "train")
    nb = knn_neighbours(train, df, max(ks), id_col, vec_col, label_col, block_rows)
    preds = knn_vote(nb, list(ks))
    truth = df.select(F.col(id_col).cast("long").alias("qid"), F.col(label_col).cast("long").alias("y"), split_col)
    scored = preds.join(truth, "qid").withColumn("hit", (F.col("prediction") == F.col("y")).cast("double"))
    return scored.groupBy("k").agg(
        F.avg(F.when(F.col(split_col) == "train", F.col("hit"))).alias("train_accuracy"),
        F.avg(F.when(F.col(split_col) == "test", F.col("hit"))).alias("test_accuracy"),
    )


# -- Spark ML estimators ------------------------------------------------------------------------


def assemble(df: DataFrame, feature_cols: list[str], out: str = "features") -> DataFrame:
    """Assemble a feature vector; a missing value is an error, so impute first."""
    names = [f"_f{i}" for i in range(len(feature_cols))]  # the assembler reads dots as nested fields
    plain = df.withColumns({n: F.col(quoted(c)) for n, c in zip(names, feature_cols)})
    return VectorAssembler(inputCols=names, outputCol=out, handleInvalid="error").transform(plain).drop(*names)


def fit_predict(estimator, train: DataFrame, test: DataFrame):
    model = estimator.fit(train)
    return model, model.transform(train), model.transform(test)


def decision_tree(max_depth: int = 2, seed: int = 40, label: str = "label") -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=max_depth, seed=seed, labelCol=label, featuresCol="features")


def random_forest_classifier(n_trees: int = 100, seed: int = 0, label: str = "label") -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=n_trees, seed=seed, labelCol=label, featuresCol="features",
                                  featureSubsetStrategy="sqrt")


def random_forest_regressor(n_trees: int = 100, min_leaf: int = 4, seed: int = 42, label: str = "label") -> RandomForestRegressor:
    """Forest regression as the published model: every feature considered at each split
    (scikit-learn's regressor default), at least ``min_leaf`` rows per leaf."""
    return RandomForestRegressor(numTrees=n_trees, minInstancesPerNode=min_leaf, seed=seed, labelCol=label,
                                 featuresCol="features", featureSubsetStrategy="all")


def gaussian_nb(label: str = "label") -> NaiveBayes:
    return NaiveBayes(modelType="gaussian", labelCol=label, featuresCol="features")


def logistic_regression(n_train: int, c: float = 1.0, label: str = "label") -> LogisticRegression:
    """L2 logistic regression with scikit-learn's ``C``: regParam = 1 / (C x n)."""
    return LogisticRegression(regParam=1.0 / (c * max(1, n_train)), elasticNetParam=0.0, standardization=False,
                              labelCol=label, featuresCol="features", maxIter=200)


def positive_probability(pred: DataFrame, col: str = "probability") -> DataFrame:
    return pred.withColumn("score", vector_to_array(F.col(col))[1])


def feature_importances(model, feature_cols: list[str], spark) -> DataFrame:
    """Model importances as a (feature, importance) table (model metadata, one row per feature)."""
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(feature_cols, imp)], "feature string, importance double")


def majority_class(train: DataFrame, label: str = "label") -> DataFrame:
    """Most frequent training label as a one-row frame (ties -> smallest label)."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    best = counts.orderBy(F.col("n").desc(), F.col(label).asc()).limit(1)
    return best.select(F.col(label).alias("majority"))


def majority_predict(test: DataFrame, train: DataFrame, label: str = "label") -> DataFrame:
    return test.withColumn("prediction", majority_class(train, label).scalar())


def cross_validate(df: DataFrame, make_estimator, id_col: str, label: str = "label", folds: int = 5,
                   metric: str = "accuracy", seed: int = 7) -> DataFrame:
    """One row per fold: fit on the other folds, score on this one. Folds are a hash of id."""
    from liftkit.operators import metrics as M

    data = df.withColumn("_fold", fold_of(id_col, folds, seed)).persist(StorageLevel.MEMORY_AND_DISK)
    rows = []
    for k in range(folds):
        train, test = data.filter(F.col("_fold") != k), data.filter(F.col("_fold") == k)
        model = make_estimator(train).fit(train)
        pred = model.transform(test).withColumn("prediction", F.col("prediction").cast("int"))
        if metric == "recall":
            c = pred.agg(*M.binary_counts(pred, label))
            row = c.select(F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).alias("score"))
        else:
            row = M.accuracy(pred, label).select(F.col("accuracy").alias("score"))
        rows.append((k, metric, test.count(), row.first()["score"]))
    data.unpersist()
    return df.sparkSession.createDataFrame(rows, "fold int, metric string, n_rows long, score double")
