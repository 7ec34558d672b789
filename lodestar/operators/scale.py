"""Scaling and imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.profile import _known
from lodestar.operators.order_stats import attach_row, column_medians_dict


def min_max_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One-row table of per-column min and max (one aggregate pass)."""
    aggs = []
    for c in columns:
        aggs += [F.min(F.col(c).cast("double")).alias(f"{c}__min"), F.max(F.col(c).cast("double")).alias(f"{c}__max")]
    return df.agg(*aggs)


def min_max(
    df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None, suffix: str = ""
) -> tuple[DataFrame, DataFrame]:
    """``(x - min) / (max - min)`` with bounds fitted on ``fit_on``
    (default: ``df`` itself); a constant column scales to 0 (sklearn), not
    Spark ML's 0.5.  Returns (scaled df, bounds row).

    The bounds are a one-row aggregate attached as a scalar subquery."""
    columns = list(columns)
    bounds = min_max_bounds(fit_on if fit_on is not None else df, columns)
    out = attach_row(df, bounds)
    for c in columns:
        lo, hi = F.col(f"{c}__min"), F.col(f"{c}__max")
        rng = hi - lo
        out = out.withColumn(
            c + suffix,
            F.when(rng == F.lit(0.0), F.lit(0.0)).otherwise((F.col(c).cast("double") - lo) / rng),
        )
    return out.drop(*[f"{c}__{s}" for c in columns for s in ("min", "max")]), bounds


def null_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns of ``columns`` holding at least one null or NaN (one aggregate pass)."""
    columns = list(columns)
    if not columns:
        return []
    row = df.agg(*[F.count(_known(df, c)).alias(str(i)) for i, c in enumerate(columns)], F.count(F.lit(1)).alias("n")).first()
    return [c for i, c in enumerate(columns) if row[str(i)] < row["n"]]


def impute_median(
    df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None, only_if_missing: bool = True
) -> DataFrame:
    """``X.fillna(X.median())`` with exact medians (Spark ML ``Imputer``
    uses an approximate quantile).  Medians are a schema-width dict.

    A fill only changes columns that hold nulls, so by default one cheap
    null-count pass decides which columns need the (sort-based) median."""
    columns = list(columns)
    src = fit_on if fit_on is not None else df
    need = null_columns(df, columns) if only_if_missing else columns
    med = column_medians_dict(src, need) if need else {}
    med = {c: med.get(c) for c in columns}
    out = df
    for c in columns:
        if med[c] is not None:
            out = out.withColumn(c, F.coalesce(_known(df, c).cast("double"), F.lit(float(med[c]))))
        else:
            out = out.withColumn(c, F.col(c).cast("double"))
    return out
