"""Mixing sources to target weights by temperature.

Each source's share of the tokens is raised to an exponent and the powers are normalised to
weights: exponent 1 keeps the shares, 0 makes all sources equal. The exponent is bisected
until the mixture meets a target: a wanted entropy, or the largest number of times any
source may be repeated. Each step evaluates a bracket's interior points in one aggregate
over the sources, so the sources may be many and nothing but a few sums reaches the driver.

The weights become token budgets. Within a source, documents are dealt into blocks, and
every pass (epoch) over the source visits its blocks in a fresh permutation. Whole passes
are taken while the budget lasts, then blocks of one more pass, and in the block where the
budget runs out its documents, in a permuted order, up to the last one that begins within
the budget.

Totals: by default the budget is such that the source with the lowest weight per token is
read exactly once, so no document is left out and the others repeat up to the limit;
``total_tokens`` sets another budget, and sources may then be read in part.

Defined results: a null source is a source of its own. A document counts its words, and at
least one token, so empty and null texts are mixed too. Rows repeated with one id count as
separate documents. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, shield, text_of, unshield

POINTS = 15      # interior points of a bracket that one step evaluates
STEPS = 8
BLOCK_DOCS = 256
REPEAT_LIMIT = 2.0
BROADCAST_SOURCES = 50_000  # rows of under 100 bytes


def tokens(text_col: str):
    """Words of a text, at least one."""
    return F.greatest(F.lit(1), F.regexp_count(text_of(text_col), F.lit(r"[^ \t\n\r]+"))).cast("long")


def counted(docs: DataFrame, source_col: str, text_col: str, id_col: str | None = None) -> DataFrame:
    """``_from, _id, _tokens`` of each document, written once."""
    rows = docs.select(F.col(source_col).cast("string").alias("_from"), (F.col(id_col) if id_col else F.lit(0)).alias("_id"),
                       tokens(text_col).alias("_tokens"))
    return materialise(rows, "counted")


def source_totals(docs: DataFrame, source_col: str, text_col: str) -> DataFrame:
    """``source, docs, tokens, share``: one grouped aggregate over the corpus."""
    return _totals(counted(docs, source_col, text_col))


def _totals(rows: DataFrame) -> DataFrame:
    per = materialise(rows.groupBy(F.col("_from").alias("source")).agg(F.count(F.lit(1)).alias("docs"), F.sum("_tokens").alias("tokens")), "totals")
    return per.withColumn("share", F.col("tokens") / per.agg(F.sum("tokens").cast("double")).scalar())


def _measures(totals: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """(entropy, repetition) of the mixture at each exponent, in one aggregate. Repetition is
    the largest number of passes when the least-weighted source is read once."""
    aggs = []
    for i, a in enumerate(exponents):
        power = F.pow("share", F.lit(a))
        aggs += [F.sum(power).alias(f"z{i}"), F.sum(power * F.log("share") * a).alias(f"l{i}"),
                 F.max(power / F.col("share")).alias(f"h{i}"), F.min(power / F.col("share")).alias(f"m{i}")]
    r = totals.agg(*aggs).first()
    out = []
    for i in range(len(exponents)):
        z, l, h, m = (r[f"{k}{i}"] for k in "zlhm")
        out.append((math.log(z) - l / z, h / m) if z else (0.0, 1.0))
    return out


def find_exponent(totals: DataFrame, entropy: float | None = None, repeat_limit: float | None = None) -> float:
    """The exponent in [0, 1] nearest to 0 that keeps the limit: repetition at most
    ``repeat_limit``, or entropy at most ``entropy`` nats. Both fall as the exponent grows."""
    if entropy is None and repeat_limit is None:
        raise ValueError("give a target entropy or a repetition limit")

    def meets(h, r):
        return (entropy is None or h <= entropy + 1e-12) and (repeat_limit is None or r <= repeat_limit * (1 + 1e-12))

    (e0, r0), (e1, r1) = _measures(totals, [0.0, 1.0])
    if meets(e0, r0):
        return 0.0
    if not meets(e1, r1):
        return 1.0
    low, high = 0.0, 1.0  # low misses the target, high meets it
    for _ in range(STEPS):
        grid = [low + (high - low) * (i + 1) / (POINTS + 1) for i in range(POINTS)]
        ok = [meets(*m) for m in _measures(totals, grid)]
        k = ok.index(True) if True in ok else POINTS
        low, high = (grid[k - 1] if k else low), (grid[k] if k < POINTS else high)
    return high


def plan(totals: DataFrame, exponent: float, total_tokens: float | None = None) -> DataFrame:
    """``source, docs, tokens, weight, budget``."""
    power = F.pow("share", F.lit(exponent))
    z = totals.agg(F.sum(power)).scalar()
    weighted = totals.withColumn("weight", power / z)
    if total_tokens is None:
        # the total at which the source with the least weight per token gets its own tokens once
        total = totals.agg(F.max(F.col("tokens") / power)).scalar() * z
    else:
        total = F.lit(float(total_tokens))
    return weighted.withColumn("budget", F.round(F.col("weight") * total).cast("long"))  # within a token of the real number


def mix(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id", seed: int = 11,
        entropy: float | None = None, repeat_limit: float | None = None, total_tokens: float | None = None) -> DataFrame:
    """``docs`` as the mixture: all input columns, one row per occurrence, and with them
    ``_tokens``, ``_weight`` (of the source), ``_epoch`` (the pass it belongs to) and
    ``_order`` (sorting by source, epoch and order gives the permuted blocks)."""
    if entropy is None and repeat_limit is None:
        repeat_limit = REPEAT_LIMIT
    docs, back = shield(docs, source_col, text_col, id_col)
    counts = counted(docs, source_col, text_col, id_col)
    totals = _totals(counts)
    planned = plan(totals, find_exponent(totals, entropy, repeat_limit), total_tokens)
    budgets = materialise(planned.select(
        F.col("source").alias("_source"), F.col("weight").alias("_weight"),
        F.expr("budget div greatest(tokens, 1)").alias("_passes"), F.expr("budget % greatest(tokens, 1)").alias("_rest"),
        F.ceil(F.col("docs") / BLOCK_DOCS).alias("_blocks")), "budgets")

    slim = _with_source(counts, budgets).withColumn("_block", _block(seed, "_id"))
    # the block of each source in which the partial pass ends; one row per block is sorted
    by_block = slim.groupBy("_source", "_passes", "_rest", "_block").agg(F.sum("_tokens").alias("held")).withColumn(
        "_turn", _turn(seed, F.col("_passes")))
    order = Window.partitionBy("_source").orderBy("_turn", "_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = by_block.withColumn("before", F.sum("held").over(order) - F.col("held")).filter(
        (F.col("before") < F.col("_rest")) & (F.col("before") + F.col("held") >= F.col("_rest"))).select(
        F.col("_source").alias("_cut_source"), F.col("_turn").alias("_cut_turn"), F.col("_block").alias("_cut_block"),
        (F.col("_rest") - F.col("before")).alias("left"))
    # and the document in that block
    edge = slim.join(cuts, slim["_source"].eqNullSafe(cuts["_cut_source"]) & (slim["_block"] == cuts["_cut_block"]))
    edge = edge.withColumn("_place", F.struct(_place(seed, F.col("_passes"), F.col("_id")).alias("h"), F.col("_id").alias("id")))
    run = Window.partitionBy("_source").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = edge.withColumn("before", F.sum("_tokens").over(run) - F.col("_tokens")).filter(F.col("before") < F.col("left")).groupBy(
        F.col("_source").alias("_cut_source"), "_cut_turn", "_cut_block").agg(F.max("_place").alias("_cut_place"))
    schedule = materialise(
        budgets.join(last, budgets["_source"].eqNullSafe(last["_cut_source"]), "left").drop("_cut_source"), "schedule")

    rows = _with_source(docs.withColumn("_from", F.col(source_col).cast("string")), schedule)
    rows = rows.withColumn("_tokens", tokens(text_col)).withColumn("_block", _block(seed, id_col)).withColumn(
        "_extra", _turn(seed, F.col("_passes"))).withColumn(
        "_mine", F.struct(_place(seed, F.col("_passes"), F.col(id_col)).alias("h"), F.col(id_col).alias("id")))
    at, cut = F.struct(F.col("_extra"), F.col("_block")), F.struct(F.col("_cut_turn"), F.col("_cut_block"))
    extra = F.col("_cut_block").isNotNull() & ((at < cut) | ((at == cut) & (F.col("_mine") <= F.col("_cut_place"))))
    copies = (F.col("_passes") + F.when(F.coalesce(extra, F.lit(False)), 1).otherwise(0)).cast("int")
    each = rows.withColumn("_copies", copies).filter("_copies > 0").withColumn(
        "_epoch", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    out = each.select(*[F.col(f"`{c}`") for c in docs.columns], "_tokens", "_weight", "_epoch",
                      F.xxhash64(F.lit(seed), F.col("_source"), F.col("_epoch").cast("long"), F.col("_block")).alias("_order"))
    return unshield(out, back)


def _block(seed: int, id_col: str):
    return F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.col("_blocks"))


def _turn(seed: int, epoch):
    """Where a block stands in the permutation of one pass."""
    return F.xxhash64(F.lit(seed), F.col("_source"), epoch, F.col("_block"))


def _place(seed: int, epoch, doc_id):
    """Where a document stands inside its block in one pass."""
    return F.xxhash64(F.lit(seed + 1), epoch, doc_id)


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Attach per-source columns by ``_from``. The source table is counted first: up to
    ``BROADCAST_SOURCES`` rows it is broadcast, beyond that the join shuffles, and adaptive
    execution splits the large sources."""
    small = sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    return rows.join(F.broadcast(sources) if small else sources, rows["_from"].eqNullSafe(sources["_source"])).drop("_from")
