"""Ranking metrics and operating thresholds from score tables.

Scores are first added up per distinct value; the cumulative counts along the scores
come from range-wise sums, so no task sees all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pipewatch.operators.cumulative import cumulative_sums, finite

DEFAULT_THRESHOLD = 0.5


def _valid(df: DataFrame, label: str, prob: str, keys: Sequence[str]) -> DataFrame:
    return (
        df.select(
            *keys,
            finite(label).cast("int").alias("_y"),
            F.least(F.greatest(finite(prob), F.lit(0.0)), F.lit(1.0)).alias("score"),
            finite(prob).alias("_p"),
        )
        .where("_y IS NOT NULL AND _p IS NOT NULL")
        .drop("_p")
    )


def score_table(
    df: DataFrame, label: str, prob: str, keys: Sequence[str] = ()
) -> DataFrame:
    """(keys, score, pos, neg, cum_pos, cum_neg), scores from the highest down."""
    counts = (
        _valid(df, label, prob, keys)
        .groupBy(*keys, "score")
        .agg(
            F.sum("_y").alias("pos"),
            (F.count(F.lit(1)) - F.sum("_y")).alias("neg"),
        )
    )
    return cumulative_sums(counts, "score", ["pos", "neg"], keys, descending=True)


def _with_positives(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    total = table.groupBy(*keys).agg(F.sum("pos").alias("_all_pos"))
    if keys:
        return table.join(total, list(keys))
    return table.withColumn("_all_pos", total.scalar())


def pr_curve(df: DataFrame, label: str, prob: str, keys: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 of predicting ``score >= threshold``."""
    t = _with_positives(score_table(df, label, prob, keys), keys)
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    recall = F.when(F.col("_all_pos") > 0, F.col("cum_pos") / F.col("_all_pos")).otherwise(1.0)
    return t.select(
        *keys,
        F.col("score").alias("threshold"),
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        precision.alias("precision"),
        recall.alias("recall"),
    ).withColumn(
        "f1",
        2 * F.col("precision") * F.col("recall")
        / (F.col("precision") + F.col("recall") + F.lit(1e-12)),
    )


def ranking_metrics(
    df: DataFrame, label: str, prob: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Average precision (step form) and ROC-AUC (ties one half); NULL for one class."""
    t = score_table(df, label, prob, keys)
    pos, neg = F.sum("pos"), F.sum("neg")
    both = (pos > 0) & (neg > 0)
    ap = F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    auc = F.sum(F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") / F.lit(2.0)))
    return t.groupBy(*keys).agg(
        F.when(both, ap / pos).alias("pr_auc"),
        F.when(both, auc / (pos.cast("double") * neg)).alias("roc_auc"),
    )


def best_f1_threshold(
    df: DataFrame, label: str, prob: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Threshold of the best F1, the lowest one on ties; 0.5 without both classes."""
    curve = pr_curve(df, label, prob, keys)
    best = F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("minus")))
    classes = (F.max("tp") > 0) & (F.max("fp") > 0)
    return curve.groupBy(*keys).agg(
        F.coalesce(F.when(classes, -best["minus"]), F.lit(DEFAULT_THRESHOLD)).alias("threshold")
    )


def confusion(
    df: DataFrame, label: str, prob: str, threshold: float, keys: Sequence[str] = ()
) -> DataFrame:
    """Counts, precision and recall of predicting ``score > threshold``."""
    v = _valid(df, label, prob, keys).withColumn("_hit", F.col("score") > F.lit(threshold))

    def n(cond: str):
        return F.count(F.when(F.expr(cond), 1))

    return (
        v.groupBy(*keys)
        .agg(
            n("_y = 0 AND NOT _hit").alias("tn"),
            n("_y = 0 AND _hit").alias("fp"),
            n("_y = 1 AND NOT _hit").alias("fn"),
            n("_y = 1 AND _hit").alias("tp"),
        )
        .withColumn("precision", F.expr("tp / greatest(tp + fp, 1)"))
        .withColumn("recall", F.expr("tp / greatest(tp + fn, 1)"))
    )


def evaluate(
    df: DataFrame, label: str, prob: str, threshold: float, keys: Sequence[str] = ("split",)
) -> DataFrame:
    """All metrics per split at one threshold."""
    keys = list(keys)
    return (
        confusion(df, label, prob, threshold, keys)
        .join(ranking_metrics(df, label, prob, keys), keys, "left")
        .withColumn("threshold", F.lit(threshold))
    )


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """One row: negatives, positives and the weight of a positive."""
    return df.agg(
        F.count(F.when(F.col(label) == 0, 1)).alias("negatives"),
        F.count(F.when(F.col(label) == 1, 1)).alias("positives"),
    ).withColumn("positive_weight", F.expr("negatives / greatest(positives, 1)"))
