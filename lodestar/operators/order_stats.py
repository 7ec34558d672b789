"""Exact order statistics without collecting a group into one task.

Spark's exact ``percentile``/``median``/``mode`` aggregates keep a map of every
distinct value of a group inside one task, and an un-partitioned window moves
the whole input into one task.  Both break when one key holds a third of the
rows.  The primitive here gives every row its 0-based position in a total
order using a range-partitioned sort:

1. ``repartitionByRange`` samples the order key, so a hot group is spread
   over many balanced partitions (rows that are equal in the whole key stay
   together: callers add a tie-breaker, or reduce equal rows to counts);
2. inside each partition rows are sorted and numbered;
3. the partition sizes (one row per partition, a bound set by configuration)
   give prefix offsets, broadcast back to turn local numbers into global ranks.

The numbered rows are staged under the checkpoint folder so that the counting
pass and the numbering pass see identical partitions, and so that lineage is
cut.  Quantiles, label codes, exact samples, stratified splits and cumulative
sums are all derived from these ranks or running counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.session import stage, stage_bounded

PID = "_pid"
LOCAL = "_local"
RANK = "_rank"
TOP_N_MAX = 10_000


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def with_global_rank(
    df: DataFrame,
    order_by: Sequence[str | Column],
    partitions: int | None = None,
    rank_col: str = RANK,
) -> DataFrame:
    """Add ``rank_col``: the row's 0-based position in ``order_by`` order.

    Ties get distinct consecutive ranks in unspecified order; callers that
    need a deterministic order include a unique tie-breaker."""
    order = _as_cols(order_by)
    # Without a fixed count AQE may merge adjacent small range partitions;
    # merged ranges stay contiguous and in order, so the arithmetic below
    # holds, and partition sizes follow the data.
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    numbered = (
        ranged
        .sortWithinPartitions(*order)
        .withColumn(PID, F.spark_partition_id())
        # monotonically_increasing_id = (partition id << 33) + row index
        .withColumn(
            LOCAL,
            F.monotonically_increasing_id()
            - F.shiftleft(F.spark_partition_id().cast("long"), 33),
        )
    )
    numbered = stage(numbered, "ranked")
    sizes = numbered.groupBy(PID).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: the window below is bounded by the partition count.
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(PID, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        numbered.join(F.broadcast(offsets), PID)
        .withColumn(rank_col, F.col("_off") + F.col(LOCAL))
        .drop("_off", PID, LOCAL)
    )


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    q: float = 0.5,
    out: str = "quantile",
    with_count: bool = False,
) -> DataFrame:
    """Exact linearly interpolated quantile of ``value`` per ``keys`` group
    (pandas ``quantile``/``median``, DuckDB ``quantile_cont``).

    Nulls and NaN are skipped; null keys are dropped like pandas ``groupby``.
    Returns one row per non-empty group: ``keys + [out]`` (+ ``n``).

    Rows are first reduced to (group, value, count), so a value that many rows
    share is one row (combined in the map tasks); running counts along
    (group, value) then say which value holds the wanted positions.  Only the
    distinct values are sorted, and nothing is joined on a rank."""
    keys = list(keys)
    v = F.col(value).cast("double")
    src = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    for k in keys:
        src = src.where(F.col(k).isNotNull())
    hist = src.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    cum = stage(running_sums(hist, [*keys, "_v"], ["_c"], prefix="_upto"), "quantile_cum")
    # counts of all earlier groups are taken off by the group's first total
    bounds = cum.groupBy(*keys).agg(F.min(F.col("_upto_c") - F.col("_c")).alias("_start"), F.sum("_c").alias("_n"))
    h = (F.col("_n") - 1).cast("double") * F.lit(float(q))
    targets = bounds.select(
        *keys, "_n", (h - F.floor(h)).alias("_frac"),
        (F.col("_start") + F.floor(h).cast("long")).alias("_r_lo"), (F.col("_start") + F.ceil(h).cast("long")).alias("_r_hi"),
    )
    holds = lambda r: (F.col("_upto_c") - F.col("_c") <= F.col(r)) & (F.col(r) < F.col("_upto_c"))
    picks = cum.join(stage_bounded(targets, "quantile_targets"), keys).where(holds("_r_lo") | holds("_r_hi"))
    # at most two rows per group
    res = picks.groupBy(*keys).agg(
        (F.min("_v") + F.first("_frac") * (F.max("_v") - F.min("_v"))).alias(out), F.first("_n").alias("n")
    )
    return res if with_count else res.drop("n")


def column_quantiles(
    df: DataFrame, columns: Sequence[str], q: float = 0.5, out: str = "median"
) -> DataFrame:
    """Exact quantile of many columns in one sorted pass: unpivot to
    ``(column, value)`` and treat the column name as the group key."""
    columns = list(columns)
    if not columns:
        raise ValueError("no columns")
    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value"))
                    for c in columns
                ]
            )
        ).alias("_kv")
    ).select("_kv.column", "_kv.value")
    return group_quantiles(long, ["column"], "value", q=q, out=out)


def column_medians_dict(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Medians of a fixed list of columns as a driver dict (one value per
    column: the result size is the schema width, not the data size)."""
    rows = column_quantiles(df, columns).collect()
    got = {r["column"]: r["median"] for r in rows}
    return {c: got.get(c) for c in columns}


def global_quantile_col(df: DataFrame, value: str, q: float = 0.5, out: str = "quantile") -> DataFrame:
    """One-row DataFrame holding the exact quantile of ``value``."""
    return group_quantiles(df.withColumn("_all", F.lit(1)), ["_all"], value, q, out).drop("_all")


def exact_sample(
    df: DataFrame, n: int, seed: int = 42, key_cols: Sequence[str] | None = None
) -> DataFrame:
    """Exactly ``min(n, count)`` rows, chosen by a seeded hash order.

    Deterministic for a fixed seed and key.  Up to ``TOP_N_MAX`` rows are a
    plain top-n in hash order.  Beyond, no task holds the sample: rows are
    ranked by ``xxhash64(key, seed)`` with the distributed rank and filtered.
    With a unique ``key_cols`` only the narrow (hash, key) table is ranked and
    the chosen keys (at most ``n``: the sample size bounds that side) are
    semi-joined back; without one, whole rows are ranked (duplicates stay
    distinct rows)."""
    if n <= TOP_N_MAX:
        # each partition offers its first n rows in hash order
        cols = list(key_cols or df.columns)
        h = F.xxhash64(*[F.col(c) for c in cols], F.lit(seed))
        return df.orderBy(h, *[F.col(c) for c in cols]).limit(n)
    if not key_cols:
        keys = df.columns
        h = F.xxhash64(*[F.col(c) for c in keys], F.lit(seed))
        ranked = with_global_rank(df.withColumn("_h", h), ["_h", *keys])
        return ranked.where(F.col(RANK) < F.lit(n)).drop("_h", RANK)
    keys = list(key_cols)
    h = F.xxhash64(*[F.col(c) for c in keys], F.lit(seed))
    narrow = df.select(*keys).withColumn("_h", h)
    chosen = with_global_rank(narrow, ["_h", *keys]).where(F.col(RANK) < F.lit(n)).select(*keys)
    cond = [df[c].eqNullSafe(chosen[c]) for c in keys]
    return df.join(chosen, cond, "left_semi")


def running_sums(
    df: DataFrame,
    order_by: Sequence[str | Column],
    sum_cols: Sequence[str],
    prefix: str = "cum_",
    inclusive: bool = True,
) -> DataFrame:
    """Cumulative sums of ``sum_cols`` along a total order, distributed.

    Per range partition: a window over that partition's rows; across
    partitions: prefix offsets from one row per partition."""
    order = _as_cols(order_by)
    numbered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(PID, F.spark_partition_id())
        .withColumn(
            LOCAL,
            F.monotonically_increasing_id()
            - F.shiftleft(F.spark_partition_id().cast("long"), 33),
        )
    )
    numbered = stage(numbered, "cumsum")
    totals = numbered.groupBy(PID).agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        PID, *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sum_cols]
    )
    frame_end = 0 if inclusive else -1
    local = Window.partitionBy(PID).orderBy(LOCAL).rowsBetween(Window.unboundedPreceding, frame_end)
    out = numbered.join(F.broadcast(offsets), PID)
    for c in sum_cols:
        out = out.withColumn(
            prefix + c, F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(local), F.lit(0))
        )
    return out.drop(PID, LOCAL, *[f"_o_{c}" for c in sum_cols])


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row of ``df`` as an
    uncorrelated scalar subquery (computed once, no join, no cross product)."""
    cols = one_row.columns
    packed = one_row.select(F.struct(*cols).alias("_row")).scalar()
    out = df.withColumn("_row", packed)
    return out.select(*df.columns, *[F.col(f"_row.{c}").alias(c) for c in cols])
