"""Label encoding (T4, A13): codes 0..k-1 in ascending string order.

The dictionary ``(column, label, code)`` is a DataFrame: distinct labels are
found by a distributed aggregation, codes come from the distributed rank, and
applying it is a join (broadcast by AQE when the dictionary is small, a
shuffle join when a column has very many labels).  Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.order_stats import RANK, with_global_rank
from lodestar.session import stage


def _prepared(c: str, fill: Mapping[str, str] | None) -> F.Column:
    v = F.col(c).cast("string")
    if fill and c in fill:
        v = F.coalesce(v, F.lit(fill[c]))
    return v


def fit_labels(df: DataFrame, columns: Sequence[str], fill: Mapping[str, str] | None = None) -> DataFrame:
    """Dictionary rows (column, label, code); labels are the string form of
    the values after ``fill`` (the reference's ``fillna(x)`` before fitting)."""
    columns = list(columns)
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), _prepared(c, fill).alias("label")) for c in columns])
        ).alias("_kv")
    ).select("_kv.column", "_kv.label")
    distinct = stage(long.where(F.col("label").isNotNull()).distinct(), "labels")
    ranked = with_global_rank(distinct, ["column", "label"])
    # one row per encoded column: as many as the caller names
    first = ranked.groupBy("column").agg(F.min(RANK).alias("_first"))
    return ranked.join(F.broadcast(first), "column").select(
        "column", "label", (F.col(RANK) - F.col("_first")).cast("int").alias("code")
    )


def apply_labels(
    df: DataFrame,
    dictionary: DataFrame,
    columns: Mapping[str, str] | Sequence[str],
    fill: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add encoded columns.  ``columns`` maps source column -> output column
    (a list encodes in place).  Unknown labels get null."""
    mapping = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    out = df
    for i, (src, dst) in enumerate(mapping.items()):
        key = f"_lbl{i}"
        d = dictionary.where(F.col("column") == F.lit(src)).select(
            F.col("label").alias(key), F.col("code").alias(f"_code{i}")
        )
        out = out.withColumn(key, _prepared(src, fill)).join(d, key, "left")
        out = out.withColumn(dst, F.col(f"_code{i}")).drop(key, f"_code{i}")
    return out


def encode(
    df: DataFrame, columns: Mapping[str, str] | Sequence[str], fill: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Fit and apply in one call; returns (encoded df, dictionary)."""
    src = list(columns.keys()) if isinstance(columns, Mapping) else list(columns)
    dictionary = fit_labels(df, src, fill)
    return apply_labels(df, dictionary, columns, fill), dictionary


def decode(df: DataFrame, dictionary: DataFrame, column: str, code_col: str, out: str) -> DataFrame:
    """Inverse mapping code -> label for one column."""
    d = dictionary.where(F.col("column") == F.lit(column)).select(F.col("code").alias("_c"), F.col("label").alias(out))
    return df.join(d, df[code_col] == d["_c"], "left").drop("_c")
