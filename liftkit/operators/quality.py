"""Quality gates: table presence and counts, evidence rubric, verdict, run summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftkit.config import DATE_DERIVED_FIELDS, PASS_SCORE, REQUIRED_TABLES, RUBRIC


def catalog_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Table and view names in the catalog, sorted (metadata only). With a database, only
    that database's tables; without, the current database's tables and the temp views."""
    names = []
    for t in spark.catalog.listTables(database):
        if not t.name or (database and t.isTemporary):
            continue
        names.append(t.name)
    return sorted(set(names))


def table_counts(spark: SparkSession, names: list[str] | None = None, database: str | None = None) -> DataFrame:
    """Row count per catalog table (optionally only the named ones), one row each.

    The per-table counts are one-row aggregates combined by ``unionByName``; each runs as a
    distributed count.
    """
    present = catalog_tables(spark, database)
    wanted = [n for n in present if names is None or n in set(names)]
    if not wanted:
        return spark.createDataFrame([], "table_name string, n_rows long")
    frames = [
        spark.table(f"`{database}`.`{n}`" if database else f"`{n}`").agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(n).alias("table_name"), "n_rows")
        for n in wanted
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def table_gate(spark: SparkSession, required=REQUIRED_TABLES, database: str | None = None) -> DataFrame:
    """Per required table: present, row count, nonempty and ok (present), plus the gate over
    all of them: every required table is there. An absent catalog fails everywhere."""
    req = spark.createDataFrame([(i, n) for i, n in enumerate(required)], "position int, table_name string")
    counts = table_counts(spark, list(required), database)
    out = req.join(counts, "table_name", "left").select(
        "table_name",
        F.col("n_rows").isNotNull().cast("int").alias("present"),
        F.col("n_rows"),
        (F.coalesce(F.col("n_rows"), F.lit(0)) > 0).cast("int").alias("nonempty"),
        F.col("n_rows").isNotNull().cast("int").alias("ok"),
    )
    gate = out.agg(F.min("ok").alias("g")).scalar()
    return out.withColumn("tables_ok", F.coalesce(gate, F.lit(0)).cast("int"))


def rubric_score(corpus: DataFrame, text_col: str = "text", rubric=RUBRIC) -> DataFrame:
    """Evidence rubric over a document table.

    A signal is found when any document contains it, case-insensitively. Every signal is a
    ``max`` aggregate in one pass over the corpus (no join of signals against documents),
    then the flags are unpivoted and scored per criterion:
    score = round-half-even(points x found / signals).
    """
    lowered = corpus.select(F.lower(F.col(text_col)).alias("_text"))  # once per text
    lower = F.col("_text")
    flags, meta = [], []
    for ci, (crit, points, signals) in enumerate(rubric):
        for si, sig in enumerate(signals):
            name = f"f_{ci}_{si}"
            flags.append(F.max(F.coalesce(lower.contains(sig.lower()), F.lit(False)).cast("int")).alias(name))
            meta.append((ci, crit, points, len(signals), si, sig, name))
    wide = lowered.agg(*flags)
    stack = ", ".join(
        f"{ci}, '{crit.replace(chr(39), chr(39) * 2)}', {pts}, {n}, {si}, '{sig.replace(chr(39), chr(39) * 2)}', {name}"
        for ci, crit, pts, n, si, sig, name in meta
    )
    long = wide.selectExpr(
        f"stack({len(meta)}, {stack}) as (criterion_order, criterion, points, n_signals, signal_order, signal, found)"
    ).withColumn("found", F.coalesce(F.col("found"), F.lit(0)))
    found_struct = F.when(F.col("found") == 1, F.struct("signal_order", "signal"))
    return long.groupBy("criterion_order", "criterion", "points", "n_signals").agg(
        F.sum("found").cast("int").alias("n_found"),
        F.array_join(F.transform(F.array_sort(F.collect_list(found_struct)), lambda x: x["signal"]), ", ").alias("found_signals"),
    ).withColumn(
        "score", F.bround(F.col("points") * F.col("n_found") / F.col("n_signals"), 0).cast("int")
    ).select("criterion_order", "criterion", "points", "n_signals", "n_found", "score", "found_signals")


def rubric_verdict(scores: DataFrame, gate: DataFrame | None = None, pass_score: int = PASS_SCORE) -> DataFrame:
    """Total score, possible score and PASS / NEEDS WORK (score >= pass and tables ok)."""
    out = scores.agg(
        F.coalesce(F.sum("score"), F.lit(0)).cast("int").alias("total_score"),
        F.coalesce(F.sum("points"), F.lit(0)).cast("int").alias("possible_score"),
    )
    tables_ok = F.lit(1) if gate is None else F.coalesce(gate.agg(F.min("tables_ok")).scalar(), F.lit(0))
    out = out.withColumn("tables_ok", tables_ok.cast("int"))
    ok = (F.col("total_score") >= pass_score) & (F.col("tables_ok") == 1)
    return out.withColumn("verdict", F.when(ok, F.lit("PASS")).otherwise(F.lit("NEEDS WORK")))


def quality_summary(listings: DataFrame, demand_panel: DataFrame, marketing: DataFrame, source: str,
                    synthetic: list[str] = DATE_DERIVED_FIELDS) -> DataFrame:
    """One-row run summary: stage row counts, sorted market list, the panel's fields that no
    input observes, source.

    The market list is a ``collect_set`` over markets (one entry per market, a bounded set).
    """
    markets = marketing.filter(F.col("borough").isNotNull()).select("borough").distinct()
    base = markets.agg(F.array_sort(F.collect_list("borough")).alias("boroughs"))
    return base.select(
        listings.agg(F.count(F.lit(1))).scalar().alias("raw_listing_rows"),
        demand_panel.agg(F.count(F.lit(1))).scalar().alias("demand_panel_rows"),
        marketing.agg(F.count(F.lit(1))).scalar().alias("marketing_panel_rows"),
        "boroughs",
        F.array(*[F.lit(s) for s in synthetic]).alias("synthetic_fields"),
        F.lit(source).alias("source"),
    )
