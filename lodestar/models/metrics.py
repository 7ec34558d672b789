"""Binary classification metrics as DataFrame aggregates.

All metrics are class-1 binary metrics with ``zero_division = 0`` (not
Spark ML's weighted metrics).  AUC is the exact rank statistic with tied
scores counted half, computed from one row per distinct score and a
distributed cumulative sum, so no task sees all predictions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.order_stats import attach_row, running_sums
from lodestar.session import stage


def _cumulate(hist: DataFrame, by, order, cols, prefix: str, inclusive: bool) -> DataFrame:
    """Cumulative sums of ``cols`` along ``order`` inside each ``by`` group:
    the distributed running sum over (group, order), less each group's start.
    A null group is a group like any other."""
    cum = stage(running_sums(hist, [*by, *order], cols, prefix=prefix, inclusive=inclusive), "score_cum")
    if not by:
        return cum
    starts = cum.groupBy(*by).agg(
        *[F.min(F.col(prefix + c) - (F.col(c) if inclusive else F.lit(0))).alias(f"_s_{c}") for c in cols]
    )
    cum = null_safe_join(cum, starts, by)
    for c in cols:
        cum = cum.withColumn(prefix + c, F.col(prefix + c) - F.col(f"_s_{c}")).drop(f"_s_{c}")
    return cum


def null_safe_join(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Inner join on ``keys`` where null equals null; keys appear once."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, cond).drop(*[f"_r_{k}" for k in keys])


def _safe_div(num, den):
    return F.when(den == F.lit(0), F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def confusion_counts(pred: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """TP/FP/TN/FN in one conditional aggregation (optionally per group)."""
    y = F.col(label).cast("int")
    p = F.col(prediction).cast("int")
    aggs = [
        F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).cast("long").alias("tp"),
        F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when((y == 0) & (p == 0), 1).otherwise(0)).cast("long").alias("tn"),
        F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0)).cast("long").alias("fn"),
    ]
    return pred.groupBy(*by).agg(*aggs) if by else pred.agg(*aggs)


def binary_metrics(
    pred: DataFrame, label: str, prediction: str, by: Sequence[str] = (), digits: int | None = 4
) -> DataFrame:
    """Accuracy, precision, recall, F1 (+ the four counts)."""
    c = confusion_counts(pred, label, prediction, by)
    tp, fp, tn, fn = F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn")
    precision = _safe_div(tp, tp + fp)
    recall = _safe_div(tp, tp + fn)
    out = c.select(
        *by,
        "tp", "fp", "tn", "fn",
        _safe_div(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _safe_div(F.lit(2) * tp, F.lit(2) * tp + fp + fn).alias("f1"),
    )
    if digits is not None:
        for m in ("accuracy", "precision", "recall", "f1"):
            out = out.withColumn(m, F.round(m, digits))
    return out


def confusion_matrix(pred: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Long 2x2 matrix (actual, predicted, count) with zero cells kept."""
    c = confusion_counts(pred, label, prediction, by)
    return c.selectExpr(
        *[f"`{b}`" for b in by],
        "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) as (actual, predicted, count)",
    )


def score_histogram(pred: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per (group, distinct score): positives and negatives."""
    y = F.col(label).cast("int")
    return pred.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.sum(F.when(y == 1, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(y == 0, 1).otherwise(0)).cast("long").alias("neg"),
    )


def roc_auc(pred: DataFrame, label: str, score: str, by: Sequence[str] = (), digits: int | None = 4) -> DataFrame:
    """AUC = P(score+ > score-) + 0.5 P(score+ = score-)."""
    hist = score_histogram(pred, label, score, by)
    # negatives strictly below each score, along (group, score) ascending
    cum = _cumulate(hist, list(by), [F.col("score")], ["neg"], "below_", inclusive=False)
    agg = cum.groupBy(*by).agg(
        F.sum(F.col("pos") * (F.col("below_neg") + F.col("neg") * F.lit(0.5))).alias("_u"),
        F.sum("pos").alias("_p"),
        F.sum("neg").alias("_n"),
    )
    auc = F.when((F.col("_p") == 0) | (F.col("_n") == 0), F.lit(None).cast("double")).otherwise(
        F.col("_u") / (F.col("_p").cast("double") * F.col("_n").cast("double"))
    )
    out = agg.select(*by, auc.alias("roc_auc"))
    return out.withColumn("roc_auc", F.round("roc_auc", digits)) if digits is not None else out


def roc_points(pred: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """One point per distinct threshold, scores descending:
    fpr/tpr of ``score >= threshold``."""
    hist = score_histogram(pred, label, score, by)
    cum = _cumulate(hist, list(by), [F.col("score").desc()], ["pos", "neg"], "cum_", inclusive=True)
    totals = cum.groupBy(*by).agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))  # from the staged histogram
    # per group: one totals row per group joined on the key; overall: a scalar row
    joined = null_safe_join(cum, totals, by) if by else attach_row(cum, totals)
    return joined.select(
        *by,
        F.col("score").alias("threshold"),
        _safe_div(F.col("cum_neg"), F.col("_N")).alias("fpr"),
        _safe_div(F.col("cum_pos"), F.col("_P")).alias("tpr"),
    )
