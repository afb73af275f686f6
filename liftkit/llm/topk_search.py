"""Exact top-k inner products by norm-bucketed retrieval.

Vectors become integers, are grouped by length (geometric classes of their norm) and each
class is cut by a hash of the id into buckets of bounded size, so a class of any size is
spread over many tasks. Queries are packed into blocks the same way. In a first pass each
query meets one bucket of the longest class that has a bucket of more than k vectors, which gives a
lower bound on its k-th score. In the second pass a block of queries meets a bucket only if the
least of its bounds is within its longest query times the bucket's longest vector, and a query
there goes on only if its own bound allows it: with t = bound /
(|query| * longest vector of the bucket), the local cosine threshold, the bucket is skipped
if t > 1, pruned by length if t is low, and by the query's largest coordinates if t is high
(a vector of cosine t or more must agree with the query in each coordinate up to
sqrt((1-q^2)(1-t^2))). Products of the survivors are then verified exactly in integers.
Each visit returns at most k rows, so no more than k rows per query and bucket are shuffled.

Defined results: vectors that are null or hold null or non-finite components take no part,
nor do rows without an id (their result could not be named). Vectors of different sizes are
compared as if the shorter ended in zeros. Equal scores rank by the smaller id. A query never
meets rows of its own id. Components beyond 64 bits after scaling, and scores, are held at the ends of
that range. Empty tables give an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise

BUCKET = 2048   # vectors in a bucket, on average
BLOCK = 512     # queries in a block, on average
LENGTH_ONLY = 0.3  # below this local threshold a coordinate interval prunes next to nothing
FOCUS = 6       # coordinates tested
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int = 64) -> DataFrame:
    """``id, v`` (floor(scale * x) as integers), without the rows that take no part."""
    v = F.col("v")
    clean = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter(
        F.col("id").isNotNull() & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return clean.select("id", F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("v"))


def _blocks(vectors: DataFrame, size: int, by_norm: bool) -> DataFrame:
    """Pack vectors into rows ``class, part, ids, values, width, longest`` of about ``size``
    vectors. The number of classes is bounded by the exponent range of the norm."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    klass = F.floor(F.log2(norm + 1) * 4).cast("int") if by_norm else F.lit(0)
    rows = vectors.select("id", "v", klass.alias("class"))
    counts = rows.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(F.broadcast(counts), "class").select(
        "class", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / size)).alias("part"), "id", "v")

    def pack(key, pdf):
        import pandas as pd

        pdf = pdf.sort_values("id", kind="stable")
        width = max((len(v) for v in pdf["v"]), default=0)
        m = np.zeros((len(pdf), width), np.int64)
        for i, v in enumerate(pdf["v"]):
            m[i, : len(v)] = v
        longest = float(np.sqrt((m.astype(np.float64) ** 2).sum(1).max())) if width else 0.0
        return pd.DataFrame({"class": [key[0]], "part": [key[1]], "n": [len(pdf)], "width": [width], "longest": [longest],
                             "ids": [pdf["id"].to_numpy(np.int64).tobytes()], "data": [m.tobytes()]})

    return rows.groupBy("class", "part").applyInPandas(
        pack, "class int, part long, n long, width int, longest double, ids binary, data binary")


def _search(k: int):
    """Map joined (query block, bucket) rows to each query's best k of the bucket."""

    def unpack(ids, data, n, width):
        return np.frombuffer(ids, np.int64), np.frombuffer(data, np.int64).reshape(n, width)

    def search(batches):
        for batch in batches:
            for r in batch.to_pylist():
                qi, q = unpack(r["q_ids"], r["q_data"], r["q_n"], r["q_width"])
                ci, c = unpack(r["ids"], r["data"], r["n"], r["width"])
                bound = np.frombuffer(r["bounds"], np.float64) if r["bounds"] is not None else np.full(len(qi), -np.inf)
                out_q, out_c, out_s = _visit(qi, q, ci, c, bound, k)
                if len(out_q):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out_q), pa.array(out_c), pa.array(out_s)], names=["query_id", "vec_id", "score"])

    return search


def _visit(qi, q, ci, c, bound, k):
    """One query block against one bucket; ``bound`` is each query's lower bound on its k-th score."""
    width = max(q.shape[1], c.shape[1])
    whole_q, whole_c = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (q, c))
    q, c = whole_q.astype(np.float64), whole_c.astype(np.float64)
    exact = (np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * max(width, 1)) < 2.0 ** 52
    qn, cn = np.sqrt((q * q).sum(1)), np.sqrt((c * c).sum(1))
    order = np.argsort(-cn, kind="stable")
    c, cn, ci, whole_c = c[order], cn[order], ci[order], whole_c[order]
    unit = c / np.maximum(cn, 1e-300)[:, None]
    out_q, out_c, out_s = [], [], []
    everything = None
    for i in range(len(qi)):
        theta = bound[i]
        top = qn[i] * (cn[0] if len(cn) else 0.0)
        if theta > top * (1 + 1e-12):
            continue  # no vector here is long enough
        live = slice(None)
        if theta > 0 and top > 0:
            # length pruning: |q| |c| < bound
            live = slice(0, int(np.searchsorted(-cn, -(theta / qn[i]) * (1 - 1e-12), side="right")))
            t = min(1.0, theta / top)
            if t >= LENGTH_ONLY:
                u = q[i] / qn[i]
                ok = np.ones(len(cn[live]), bool)
                for f in np.argsort(-np.abs(u))[:FOCUS]:
                    slack = np.sqrt(max(0.0, (1 - u[f] * u[f]) * (1 - t * t))) + 1e-9
                    ok &= unit[live, f] * u[f] >= t * u[f] * u[f] - slack * abs(u[f])
                live = np.flatnonzero(ok)
        if isinstance(live, slice) and live == slice(None):
            if everything is None:
                everything = q @ c.T
            s, names = everything[i], ci
        else:
            s, names = c[live] @ q[i], ci[live]
        if exact:
            s = np.rint(s).astype(np.int64)
        else:
            mine = whole_q[i].tolist()  # beyond 2^52: Python's integers
            s = np.array([max(LEAST, min(MOST, sum(a * b for a, b in zip(mine, row)))) for row in whole_c[live].tolist()], dtype=np.int64)
        keep = (names != qi[i]) & (s >= theta)
        s, names = s[keep], names[keep]
        if len(s) > k:
            cut = np.partition(s, len(s) - k)[len(s) - k]
            near = s >= cut
            s, names = s[near], names[near]
        best = np.lexsort((names, -s))[:k]
        out_q.append(np.full(len(best), qi[i], np.int64))
        out_c.append(names[best])
        out_s.append(s[best])
    cat = lambda a: np.concatenate(a) if a else np.array([], np.int64)
    return cat(out_q), cat(out_c), cat(out_s)


FOUND = "query_id long, vec_id long, score long"


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_k(df: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20,
          bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each id divisible by ``every``, its k best."""
    vectors = integer_vectors(df, id_col, vector_col)
    cands = materialise(_blocks(vectors, bucket, True), "buckets")
    queries = _blocks(vectors.filter(F.col("id") % every == 0), block, False)
    queries = materialise(queries.select(F.col("part").alias("q_part"), F.col("n").alias("q_n"), F.col("width").alias("q_width"), F.col("longest").alias("q_longest"),
                                         F.col("ids").alias("q_ids"), F.col("data").alias("q_data")), "queries")
    # first pass: each block meets one bucket of the longest class, picked by the block's number
    top = cands.agg(F.coalesce(F.max(F.when(F.col("n") > k, F.col("class"))), F.max("class"))).scalar()
    first = cands.filter(F.col("class") == top)
    heads = first.select("class", "part").agg(F.max("part").alias("last"))
    met = queries.withColumn("part", F.pmod(F.col("q_part"), heads.scalar() + 1)).withColumn("class", top)
    bounds_in = met.join(cands, ["class", "part"]).withColumn("bounds", F.lit(None).cast("binary"))
    cols = ["q_n", "q_width", "q_ids", "q_data", "n", "width", "ids", "data", "bounds"]
    begun = bounds_in.select("q_part", *cols).mapInArrow(_search(k), FOUND)
    low = begun.groupBy("query_id").agg(F.count(F.lit(1)).alias("held"), F.min("score").alias("low")).filter(F.col("held") >= k)

    # a block's bounds in the order of its ids; small (one number a query), joined by block
    ids = queries.select("q_part", "q_n", "q_ids").mapInArrow(_query_ids, "q_part long, query_id long, pos long")
    per_block = ids.join(low, "query_id", "left").groupBy("q_part").applyInPandas(
        _bounds, "q_part long, bounds binary, least double")
    # second pass: every bucket that some query of the block may need; bucket names only, not their data
    names = cands.select("class", "part", "longest").agg(F.sort_array(F.collect_list(F.struct("class", "part", "longest"))).alias("names"))
    visits = queries.join(per_block, "q_part").withColumn("visit", F.explode(names.scalar())).filter(
        F.col("least") <= F.col("q_longest") * F.col("visit.longest") * (1 + 1e-9) + 1).drop("longest").select(
        "*", F.col("visit.class").alias("class"), F.col("visit.part").alias("part"))
    found = visits.join(cands, ["class", "part"]).select(*cols).mapInArrow(_search(k), FOUND)
    best = _best(found, k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _query_ids(batches):
    for batch in batches:
        for r in batch.to_pylist():
            ids = np.frombuffer(r["q_ids"], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), r["q_part"], np.int64)), pa.array(ids), pa.array(np.arange(len(ids)))],
                names=["q_part", "query_id", "pos"])


def _bounds(pdf):
    import pandas as pd

    b = pdf.sort_values("pos")["low"].astype("float64").fillna(-np.inf).to_numpy()
    return pd.DataFrame({"q_part": [pdf["q_part"].iloc[0]], "bounds": [b.tobytes()], "least": [float(b.min())]})


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
