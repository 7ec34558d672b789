"""Group statistic flags (A2, A3 + J3 + P9).

``price > median(price) within state`` is computed as an exact grouped
median (skew-safe, see order_stats) joined back on the group key.  The
median table has one row per group; it is staged and broadcast when a count
shows at most ``BROADCAST_ROWS_MAX`` groups, else joined by a shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.exprs import threshold_flag
from lodestar.operators.order_stats import attach_row, global_quantile_col, group_quantiles
from lodestar.session import stage_bounded


def group_stat_flag(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    stat_col: str | None = None,
    op: str = ">",
    q: float = 0.5,
) -> DataFrame:
    """Adds the group quantile (``stat_col``) and ``out`` = value op stat
    (0/1; null value or null group -> 0, like pandas)."""
    keys = list(keys)
    stat_col = stat_col or f"{value}_group_median"
    med = stage_bounded(group_quantiles(df, keys, value, q=q, out=stat_col), "group_stat")
    joined = df.join(med, keys, "left")
    return joined.withColumn(out, threshold_flag(value, F.col(stat_col), op))


def median_flag(df: DataFrame, value: str, out: str, op: str = ">", stat_col: str | None = None) -> DataFrame:
    """A2 + P9: ``value op median(value)`` over the whole table."""
    stat_col = stat_col or f"{value}_median"
    med = global_quantile_col(df, value, out=stat_col)  # one row
    joined = attach_row(df, med)
    return joined.withColumn(out, threshold_flag(value, F.col(stat_col), op))
