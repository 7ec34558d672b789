"""Whole-table preparation: clean_table (T1), infer_target (T2),
binarize_target (T3) and the generic ML-ready assembly (F9).

Statistics are computed in at most three distributed passes (non-null
counts; medians + modes + std after de-duplication), and only per-column
scalars (schema-width) reach the driver to decide which columns to keep.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.exprs import trim_strings
from lodestar.operators.encode import apply_labels, fit_labels
from lodestar.operators.order_stats import attach_row, column_medians_dict, global_quantile_col
from lodestar.operators.profile import _known, modes, non_null_counts, numeric_columns, stddevs, string_columns, two_valued
from lodestar.session import stage
from lodestar.sources.io import model_safe_name, table_registry

# Fixed values that must match the reference: target-name candidates, tried
# in this order, case-insensitively.
TARGET_CANDIDATES = [
    "churn", "churned", "attrition", "left", "exited",
    "target", "label", "y", "is_churn", "customer_status",
]
TARGET_COLUMN = "churn"
UNKNOWN_MODE = "Unknown"
MIN_NON_NULL_SHARE = 0.5


def clean_table(df: DataFrame, min_non_null: float = MIN_NON_NULL_SHARE) -> DataFrame:
    """Ordered: trim strings -> drop columns with fewer than
    ``int(n * min_non_null)`` non-null values -> drop duplicate rows ->
    fill numeric nulls with the median and string nulls with the mode
    ("Unknown" when a column has no value) -> drop numeric columns whose
    sample std is 0 -> model-safe column names."""
    df = trim_strings(df)
    counts = {r["column"]: (r["n_rows"], r["non_null"]) for r in non_null_counts(df).collect()}
    n_rows = next(iter(counts.values()))[0] if counts else 0
    thresh = int(n_rows * min_non_null)
    keep = [c for c in df.columns if counts[c][1] >= thresh]
    # de-duplicated rows feed three statistics and the output: stage once
    dedup = stage(df.select(*[F.col(f"`{c}`") for c in keep]).dropDuplicates(), "dedup")
    nums = numeric_columns(dedup)
    strs = string_columns(dedup)
    fills: dict[str, object] = {}
    # a fill only matters where nulls remain; non-null counts after the
    # de-duplication decide which statistics are needed at all
    dcounts = {r["column"]: (r["n_rows"], r["non_null"]) for r in non_null_counts(dedup).collect()}
    holes = {c for c, (n, nn) in dcounts.items() if nn < n}
    num_holes = [c for c in nums if c in holes]
    str_holes = [c for c in strs if c in holes]
    if num_holes:
        med = column_medians_dict(dedup, num_holes)
        fills.update({c: v for c, v in med.items() if v is not None})
    if str_holes:
        got = {r["column"]: r["mode"] for r in modes(dedup, str_holes).collect()}
        fills.update({c: got.get(c, UNKNOWN_MODE) for c in str_holes})
    filled = dedup
    for c, v in fills.items():
        filled = filled.withColumn(c, F.coalesce(_known(dedup, c), F.lit(v).cast(dedup.schema[c].dataType)))
    drop = []
    if nums:
        stds = {r["column"]: r["std"] for r in stddevs(filled, nums).collect()}
        drop = [c for c in nums if stds.get(c) is not None and stds[c] == 0.0]
    out = filled.select(*[F.col(f"`{c}`") for c in filled.columns if c not in drop])
    return out.toDF(*[model_safe_name(c) for c in out.columns])


def infer_target(df: DataFrame, candidates: Sequence[str] = TARGET_CANDIDATES) -> str:
    """First candidate name present (case-insensitive); else the last column
    with exactly two distinct non-null values; else the last column."""
    lower = {c.lower(): c for c in df.columns}
    for cand in candidates:
        if cand in lower:
            return lower[cand]
    return (two_valued(df) or df.columns)[-1]


def binarize_target(df: DataFrame, target: str = TARGET_COLUMN) -> DataFrame:
    """Two distinct values -> smaller 0, larger 1.  With no target column a
    target is synthesised from the last numeric column: value > median."""
    if target in df.columns:
        stats = df.where(F.col(target).isNotNull()).agg(
            F.min(target).alias("lo"), F.max(target).alias("hi"), F.count_distinct(target).alias("nd")
        )
        lo, hi, nd = stats.first()
        if nd == 2:
            c = F.col(target)
            return df.withColumn(target, F.when(c == F.lit(lo), 0).when(c == F.lit(hi), 1).cast("int"))
        return df
    last = numeric_columns(df)[-1]
    med = global_quantile_col(df, last, out="_m")
    return attach_row(df, med).withColumn(
        target, F.coalesce(F.col(last) > F.col("_m"), F.lit(False)).cast("int")
    ).drop("_m")


def ml_ready(tables: Mapping[str, DataFrame], target: str = TARGET_COLUMN) -> tuple[DataFrame, str]:
    """clean every table, keep the largest (rows x cols; the reference's
    "merge" keeps only that one), infer the target, label-encode every string
    column, rename the target and binarize it.  Returns (table, source target)."""
    cleaned = {name: clean_table(df) for name, df in tables.items()}
    reg = {r["table_name"]: r["rows"] * r["n_cols"] for r in table_registry(None, cleaned).collect()}
    base_name = sorted(reg, key=lambda k: (-reg[k], list(tables).index(k)))[0]
    base = cleaned[base_name]
    found = infer_target(base)
    strs = string_columns(base)
    if strs:
        base = apply_labels(base, fit_labels(base, strs), strs)
    if found != target and found in base.columns:
        base = base.withColumnRenamed(found, target)
    return binarize_target(base, target), found
