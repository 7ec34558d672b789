"""Model queries: ``(spark, sf_dir) -> DataFrame`` jobs that fit models
(SMOTE, the classifier panel, importances, cross-validation, tuning,
bundles).  They read the driver's tables like every other
query; their outputs depend on fitted models, so they have no SQL oracle
and are checked by invariant tests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.models import metrics as M
from lodestar.models.families import LABEL, PROFILES
from lodestar.models.panel import cross_validate_all, prepare, retrain_until, train_panel
from lodestar.models.score import batch_score, load_bundle, make_bundle, save_bundle, top_importances
from lodestar.operators import rank as R
from lodestar.operators.neighbors import smote
from lodestar.operators.select import importance_table, rf_importance
from lodestar.operators.split import class_counts
from lodestar.plans.catalog import ORACLE_SQL
from lodestar.plans.features import churn_features, market_position_single
from lodestar.session import checkpoint_root, stage

CHURN_FEATURES = [
    "segment_enc", "nation", "avg_calls", "avg_views", "avg_discount", "avg_revenue", "c_acctbal", "total_deals", "months_active",
]
# no price-derived column: the target is price above the state median
MARKET_FEATURES = ["acctbal", "order_day", "state_enc", "priority_enc"]


def _churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(churn_features(spark, sf_dir), "churn_table")


def _market_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 rows with non-price attributes of the listing (buyer balance,
    listing day) joined on the order key."""
    from lodestar.sources.io import read_table

    rows = market_position_single(spark, sf_dir)
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("acctbal"))
    extra = orders.join(cust, orders.o_custkey == cust.c_custkey, "left").select(
        "o_orderkey", "acctbal", F.datediff(F.col("o_orderdate"), F.lit("1990-01-01")).alias("order_day")
    )
    return stage(rows.join(extra, "o_orderkey", "left"), "market_rows")


def smote_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: class sizes before/after SMOTE on the churn table.  A class of at most
    five rows has fewer neighbours to draw from: all its other rows."""
    churn = _churn(spark, sf_dir)
    k = max(1, min([5, *[n - 1 for n in class_counts(churn, "churned").values()]]))
    bal = smote(churn, "churned", CHURN_FEATURES, k=k, seed=42)
    return bal.groupBy("churned").agg(
        F.count(F.lit(1)).alias("n"), F.sum("synthetic").cast("long").alias("n_synthetic")
    )


def market_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The market task's families and settings on the market-position rows."""
    rows = _market_rows(spark, sf_dir)
    scores, _, _ = train_panel(rows, "above_market", MARKET_FEATURES, profile="market", key_cols=["o_orderkey"])
    return R.rank_models(scores, "f1", within=[], tie=["model"])


def _balanced(train: DataFrame) -> DataFrame:
    return smote(train, "label", CHURN_FEATURES, k=5, seed=42)


def churn_smote_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The churn task: the panel, its training rows balanced by SMOTE (never the
    test rows)."""
    scores, _, _ = train_panel(
        _churn(spark, sf_dir), "churned", CHURN_FEATURES, profile="churn", key_cols=["customer_id"], balance=_balanced
    )
    return scores


def panel_best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best family by F1 (first in panel order on ties)."""
    rows = _market_rows(spark, sf_dir)
    scores, _, _ = train_panel(rows, "above_market", MARKET_FEATURES, profile="market", key_cols=["o_orderkey"])
    return R.best_model(scores.withColumn("task", F.lit("market")), within=["task"], by="f1")


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random-forest importances on the churn table."""
    return rf_importance(_churn(spark, sf_dir), "churned", CHURN_FEATURES, trees=100)


def cross_validated_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-fold stratified CV F1 of every churn family over all prepared
    rows (the reference cross-validates on the whole scaled table)."""
    prep = prepare(_churn(spark, sf_dir), "churned", CHURN_FEATURES, key_cols=["customer_id"], fit_scope="all")
    rows = prep.train.unionByName(prep.test)
    f1s = cross_validate_all(rows, PROFILES["churn"].families, profile="churn", folds=5)
    return spark.createDataFrame([(name, float(f1)) for name, f1 in f1s.items()], "model string, cv_f1 double")


def retrain_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to ten retrain iterations of the market task's families
    and the running best.  From the second one on, every family with a grid is
    tuned over that iteration's grid (3-fold CV F1)."""
    rows = _market_rows(spark, sf_dir)
    hist = retrain_until(rows, "above_market", MARKET_FEATURES, max_iter=10, profile="market")
    return R.running_best(hist, "iteration", ["f1", "roc_auc"])


def batch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12 + M19: fit, save and reload a bundle, then score every customer
    row (with one feature column missing, so its saved default is used)."""
    churn = _churn(spark, sf_dir)
    scores, fitted, prep = train_panel(churn, "churned", CHURN_FEATURES, profile="churn", families=["RandomForest"], key_cols=["customer_id"])
    bundle = make_bundle(fitted["RandomForest"], "RandomForest", CHURN_FEATURES, churn, prep.bounds)
    path = f"{checkpoint_root(spark).rstrip('/')}/bundles/churn-{uuid.uuid4().hex}"
    save_bundle(bundle, path)
    loaded = load_bundle(spark, path)
    return batch_score(churn.drop("avg_views"), loaded, keep=["customer_id", "churned"])


def bundle_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-5 importances of the best tree model."""
    churn = _churn(spark, sf_dir)
    _, fitted, prep = train_panel(churn, "churned", CHURN_FEATURES, profile="churn", families=["RandomForest"], key_cols=["customer_id"])
    bundle = make_bundle(fitted["RandomForest"], "RandomForest", CHURN_FEATURES, churn, prep.bounds)
    return top_importances(spark, bundle, k=5)


def panel_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2 x 2 confusion counts of every trained market family."""
    rows = _market_rows(spark, sf_dir)
    _, _, prep = train_panel(rows, "above_market", MARKET_FEATURES, profile="market", key_cols=["o_orderkey"])
    return M.confusion_matrix(prep.predictions, LABEL, "prediction", by=["model"])


def panel_roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC points of every trained market family."""
    rows = _market_rows(spark, sf_dir)
    _, _, prep = train_panel(rows, "above_market", MARKET_FEATURES, profile="market", key_cols=["o_orderkey"])
    return M.roc_points(prep.predictions, LABEL, "score", by=["model"])


def panel_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked importances of every trained market family that has any."""
    rows = _market_rows(spark, sf_dir)
    _, fitted, _ = train_panel(rows, "above_market", MARKET_FEATURES, profile="market", key_cols=["o_orderkey"])
    with_any = {n: m.importances for n, m in fitted.items() if m.importances is not None}
    tables = {n: importance_table(spark, MARKET_FEATURES, v) for n, v in with_any.items()}
    return R.tag_and_union(tables, "model")


def pairplot_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five scaled numeric features plus the target, at most
    500 rows by a seeded exact sample (the sample size is the feature)."""
    from lodestar.operators.order_stats import exact_sample
    from lodestar.operators.scale import min_max
    from lodestar.plans.features import listing_sold_features

    df = stage(listing_sold_features(spark, sf_dir), "listing_rows")
    feats = ["type_enc", "flag_enc", "brand_no", "p_size", "p_retailprice"]
    scaled, _ = min_max(df, feats)
    picked = exact_sample(scaled.select("l_orderkey", "l_linenumber", *feats, "sold"), 500, seed=42)
    return picked.select(*feats, "sold")


def agent_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generic agent lifecycle as Spark jobs: ML-ready table (F9) ->
    correlation pairs (A10, target included) -> forest importances (T9) ->
    correlated-pair pruning (T10) -> min-max scaling and panel (T6, M10) ->
    ranking by the mean of F1 and AUC (O6)."""
    from lodestar.operators.profile import corr_pairs, numeric_columns
    from lodestar.operators.select import prune_correlated
    from lodestar.plans.features import ml_ready_tables
    from lodestar.operators.clean import ml_ready

    table, _ = ml_ready(ml_ready_tables(spark, sf_dir))
    table = stage(table, "agent_ready")
    candidates = [c for c in numeric_columns(table) if c not in ("churn", "doc_id")]
    imp = rf_importance(table, "churn", candidates, trees=100)
    pairs = corr_pairs(table, candidates + ["churn"], digits=2)
    kept = [r["feature"] for r in prune_correlated(pairs, imp).orderBy("rank").collect()]  # schema-sized list
    scores, _, _ = train_panel(table, "churn", kept or candidates, profile="agent", key_cols=["doc_id"], cv_folds=5)
    mean = (F.col("f1") + F.col("roc_auc")) / 2
    return R.rank_models(scores.withColumn("f1_auc_mean", mean), "f1_auc_mean", within=[], tie=["model"]).withColumn(
        "features", F.lit(",".join(kept))
    )


MODEL_QUERIES = {
    "pairplot_sample": pairplot_sample,
    "agent_pipeline": agent_pipeline,
    "smote_balance": smote_balance,
    "market_panel": market_panel,
    "churn_smote_panel": churn_smote_panel,
    "panel_best_model": panel_best_model,
    "feature_importance": feature_importance,
    "cross_validated_f1": cross_validated_f1,
    "retrain_history": retrain_history,
    "batch_scores": batch_scores,
    "bundle_importances": bundle_importances,
    "panel_confusion": panel_confusion,
    "panel_roc_points": panel_roc_points,
    "panel_importances": panel_importances,
}

# Class sizes after oversampling have an exact form: every class reaches the
# size of the largest one.
MODEL_ORACLE_SQL = {
    "smote_balance": f"""
WITH churn AS ({ORACLE_SQL['churn_features']}),
sizes AS (SELECT churned, count(*) AS had FROM churn GROUP BY churned)
SELECT churned, (SELECT max(had) FROM sizes) AS n, (SELECT max(had) FROM sizes) - had AS n_synthetic FROM sizes""",
}
