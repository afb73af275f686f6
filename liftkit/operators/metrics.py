"""Model evaluation as aggregates: confusion matrix, accuracy, F1, per-class report,
ROC AUC by average rank, R^2.

All are conditional sums in one pass (partial aggregation); none needs a Python UDF. The
AUC ranks scores through a count per distinct score, so raw rows are never sorted in one
task: the rank table has one row per distinct score, ranked bucket by bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftkit.operators import ranking


def confusion_matrix(pred: DataFrame, classes: list | None = None, label: str = "label",
                     prediction: str = "prediction", sparse: bool = False) -> DataFrame:
    """Long-form confusion matrix over every (actual, predicted) class pair, zeros included,
    whatever the number of classes; with ``sparse`` only the pairs that occur.

    Without ``classes`` they are those found in either column. The grid is built by exploding
    the class list (one row), not by joining tables.
    """
    counts = pred.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).cast("long").alias("n"))
    if sparse:
        return counts
    if classes is None:
        seen = counts.select(F.explode(F.array("actual", "predicted")).alias("c"))
        found = seen.agg(F.array_sort(F.collect_set("c")).alias("cs"))
    else:
        found = pred.sparkSession.range(1).select(F.array(*[F.lit(c) for c in classes]).alias("cs"))
    grid = found.select(F.explode("cs").alias("actual"), "cs").select("actual", F.explode("cs").alias("predicted"))
    return grid.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def binary_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction", positive=1) -> list:
    y, p = F.col(label) == positive, F.col(prediction) == positive
    return [
        F.sum((y & p).cast("long")).alias("tp"),
        F.sum((~y & p).cast("long")).alias("fp"),
        F.sum((y & ~p).cast("long")).alias("fn"),
        F.sum((~y & ~p).cast("long")).alias("tn"),
    ]


def f1_score(pred: DataFrame, label: str = "label", prediction: str = "prediction", positive=1) -> DataFrame:
    """F1 of the positive class: 2tp / (2tp + fp + fn); 0 when undefined (sklearn's default)."""
    c = pred.agg(*binary_counts(pred, label, prediction, positive))
    den = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return c.withColumn("f1", F.when(den > 0, 2 * F.col("tp") / den).otherwise(F.lit(0.0)))


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, plus accuracy, macro and weighted rows.

    Undefined ratios are 0 (sklearn's ``zero_division`` default). Classes are the labels that
    occur in either column; per-class counts are one grouped pass over (actual, predicted).
    """
    pairs = pred.groupBy(F.col(label).alias("a"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    actual = pairs.groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("support"))
    predicted = pairs.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("n_pred"))
    hits = pairs.filter(F.col("a") == F.col("p")).select(F.col("a").alias("cls"), F.col("n").alias("tp"))
    per = (
        actual.join(predicted, "cls", "full").join(hits, "cls", "left")
        .select("cls", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("support", "n_pred", "tp")])
    )
    per = per.withColumns(
        {
            "precision": F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0),
            "recall": F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0),
        }
    ).withColumn(
        "f1",
        F.when(F.col("precision") + F.col("recall") > 0,
               2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0),
    )
    rows = per.select(F.col("cls").cast("string").alias("row"), "precision", "recall", "f1",
                      F.col("support").cast("long").alias("support"))
    total = per.agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("n"), F.count(F.lit(1)).alias("k"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"), F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1") * F.col("support")).alias("wf"),
    )
    acc = total.select(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                       F.lit(None).cast("double").alias("recall"), (F.col("tp") / F.col("n")).alias("f1"),
                       F.col("n").cast("long").alias("support"))
    macro = total.select(F.lit("macro avg").alias("row"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                         F.col("mf").alias("f1"), F.col("n").cast("long").alias("support"))
    weighted = total.select(F.lit("weighted avg").alias("row"), (F.col("wp") / F.col("n")).alias("precision"),
                            (F.col("wr") / F.col("n")).alias("recall"), (F.col("wf") / F.col("n")).alias("f1"),
                            F.col("n").cast("long").alias("support"))
    return rows.unionByName(acc).unionByName(macro).unionByName(weighted)


def score_ranks(pred: DataFrame, score: str = "score", label: str = "label", positive=1) -> DataFrame:
    """One row per distinct score: count, positives and the average (tie-corrected) rank.

    The per-score table is ranked through buckets of the score (``ranking``), so no step
    sorts all scores in one task.
    """
    per = pred.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("s")).agg(
        F.count(F.lit(1)).alias("cnt"), F.sum((F.col(label) == positive).cast("long")).alias("pos"))
    out = ranking.ordered_offsets(per, "s", weight=F.col("cnt"))
    # ranks of the tied block are _before + 1 .. _before + cnt; their average:
    return out.select("s", "cnt", "pos", (F.col("_before") + (F.col("cnt") + 1) / 2.0).alias("avg_rank"))


def roc_auc(pred: DataFrame, score: str = "score", label: str = "label", positive=1) -> DataFrame:
    """Exact ROC AUC by the rank-sum (Mann-Whitney) form with averaged ties."""
    ranks = score_ranks(pred, score, label, positive)
    agg = ranks.agg(
        F.sum(F.col("pos") * F.col("avg_rank")).alias("rank_sum"),
        F.sum("pos").alias("n_pos"),
        F.sum(F.col("cnt") - F.col("pos")).alias("n_neg"),
    )
    auc = (F.col("rank_sum") - F.col("n_pos") * (F.col("n_pos") + 1) / 2.0) / (F.col("n_pos") * F.col("n_neg"))
    return agg.select(F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), auc).alias("roc_auc"),
                      F.col("n_pos").cast("long").alias("n_pos"), F.col("n_neg").cast("long").alias("n_neg"))


def r2_score(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """1 - SS_res / SS_tot in one pass; SS_tot = n x population variance (Spark's variance
    aggregate is the numerically stable streaming form)."""
    agg = pred.agg(
        F.sum((F.col(label) - F.col(prediction)) ** 2).alias("ss_res"),
        (F.var_pop(label) * F.count(label)).alias("ss_tot"),
    )
    return agg.select(F.when(F.col("ss_tot") > 0, 1 - F.col("ss_res") / F.col("ss_tot")).alias("r2"))
