"""Evaluation stand-ins: scored rows from the labelled documents.

Three deterministic scorers (saturating functions of document length,
word count and line count) are judged against two label columns (quality,
toxic).  This gives a (task, model) score table whose metrics, ROC points,
rankings and score cards are exactly reproducible in SQL, so the metric and
ranking operators are oracle-checked; trained Spark ML models feed the same
operators in ``models.panel``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import exprs as X
from lodestar.models import metrics as M
from lodestar.operators import rank as R
from lodestar.sources.io import read_table

# (model, order, feature column, half-saturation constant)
SCORERS = [("length", 1, "n_chars", 2000.0), ("words", 2, "words", 300.0), ("lines", 3, "lines", 20.0)]
TASKS = [("quality", 1), ("toxic", 2)]
THRESHOLD = 0.5
DISPLAY = {0: "Negative", 1: "Positive"}


def scored_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, task, model, model_order, label, score, prediction)."""
    labels = read_table(spark, sf_dir, "labels")
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        X.word_count("text").cast("double").alias("words"),
        X.line_count("text").cast("double").alias("lines"),
    )
    base = labels.join(docs, "doc_id", "inner")
    models = F.explode(
        F.array(
            *[
                F.struct(F.lit(m).alias("model"), F.lit(o).alias("model_order"), (F.col(c) / (F.col(c) + F.lit(k))).alias("score"))
                for m, o, c, k in SCORERS
            ]
        )
    )
    tasks = F.explode(F.array(*[F.struct(F.lit(t).alias("task"), F.col(t).alias("label")) for t, _ in TASKS]))
    long = base.select("doc_id", tasks.alias("t"), "n_chars", "words", "lines").select(
        "doc_id", "t.task", "t.label", "n_chars", "words", "lines"
    )
    long = long.select("doc_id", "task", "label", models.alias("m")).select(
        "doc_id", "task", "label", "m.model", "m.model_order", "m.score"
    )
    return long.withColumn("prediction", X.threshold_flag("score", THRESHOLD, ">="))


def heuristic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P24/P25 row output: rounded score, display label and percentage."""
    s = scored_long(spark, sf_dir)
    return s.select(
        "doc_id", "task", "model", "label", "prediction",
        F.round("score", 8).alias("score"),
        X.display_label("prediction", DISPLAY).alias("prediction_label"),
        X.percent("score", 1).alias("probability_pct"),
    )


def score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(task, model, model_order, accuracy, precision, recall, f1, roc_auc):
    one score table per task, tagged and concatenated (U4)."""
    s = scored_long(spark, sf_dir)
    by = ["model", "model_order"]
    per_task = {}
    for t, _ in TASKS:
        st = s.where(F.col("task") == F.lit(t))
        bm = M.binary_metrics(st, "label", "prediction", by=by)
        auc = M.roc_auc(st, "label", "score", by=by)
        per_task[t] = bm.join(auc, by).select(*by, "accuracy", "precision", "recall", "f1", "roc_auc")
    return R.tag_and_union(per_task, "task").select("task", *by, "accuracy", "precision", "recall", "f1", "roc_auc")


def binary_metrics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored_long(spark, sf_dir)
    return M.binary_metrics(s, "label", "prediction", by=["task", "model"])


def confusion_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored_long(spark, sf_dir)
    return M.confusion_matrix(s, "label", "prediction", by=["task", "model"])


def auc_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored_long(spark, sf_dir)
    return M.roc_auc(s, "label", "score", by=["task", "model"], digits=6)


def roc_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored_long(spark, sf_dir)
    pts = M.roc_points(s, "label", "score", by=["task", "model"])
    return pts.select(
        "task", "model", F.round("threshold", 8).alias("threshold"), F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr")
    )


def model_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1/O2: rank per task by F1 desc, model name asc."""
    return R.rank_models(score_table(spark, sf_dir), "f1", within=["task"], tie=["model"]).drop("model_order")


def best_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best model per task by F1 (first in model order on ties)."""
    return R.best_model(score_table(spark, sf_dir), within=["task"], by="f1").drop("model_order")


def best_models_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.best_by_mean(score_table(spark, sf_dir), within=["task"]).drop("model_order")


def score_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.score_cards(score_table(spark, sf_dir), within=["task"])


def metric_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long metric rows."""
    return R.unpivot_metrics(score_table(spark, sf_dir).drop("model_order"))


def f1_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model x task F1 table."""
    return R.pivot_metric(score_table(spark, sf_dir), "f1", rows="model", cols="task", values=[t for t, _ in TASKS])
