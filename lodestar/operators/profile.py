"""Table profiling and statistics.

Every statistic over many columns is one aggregate pass (or one sorted pass
for exact medians), never a per-column loop of jobs.  Modes use a two-level
aggregation instead of Spark's ``mode`` aggregate, whose per-group value map
would sit in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.operators.order_stats import column_quantiles

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _value(df: DataFrame, c: str) -> Column:
    v = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        return F.when(v == F.lit(0.0), F.lit(0.0)).otherwise(v)  # -0.0 and 0.0 are one value
    return v


def _texts(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    return [_value(df, c).cast("string") for c in columns]


def _long(df: DataFrame, columns: Sequence[str], as_string: bool = True) -> DataFrame:
    """Unpivot to (column, value) rows."""
    cast = "string" if as_string else "double"
    return df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _value(df, c).cast(cast).alias("value")) for c in columns])).alias("_kv")
    ).select("_kv.column", "_kv.value")


def non_null_counts(df: DataFrame) -> DataFrame:
    """(column, n_rows, non_null) for all columns in one pass."""
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"), _rows_of("non_null", [(c, F.count(_known(df, c))) for c in df.columns]))
    return wide.select("n_rows", F.explode("r").alias("r")).select("r.column", "n_rows", "r.non_null")


def _known(df: DataFrame, c: str):
    """The column with NaN as null (pandas has one missing marker)."""
    v = F.col(f"`{c}`")
    return F.nanvl(v, F.lit(None).cast(df.schema[c].dataType)) if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) else v


def _rows_of(value: str, pairs) -> Column:
    """One (column, value) struct per pair, as an array: names are data here,
    so quotes and dots in them need no escaping."""
    return F.array(*[F.struct(F.lit(c).alias("column"), v.alias(value)) for c, v in pairs]).alias("r")


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A5: non-null distinct count per column, one job.

    Values meet as 128-bit fingerprints (two seeded 64-bit hashes of their text
    form), so whole texts are never shuffled; two values of a column with one
    fingerprint are not to be expected below 10**18 of them."""
    columns = list(columns or df.columns)
    prints = lambda v: F.struct(F.xxhash64(v).alias("a"), F.xxhash64(F.lit(1), v).alias("b"))
    each = [F.struct(F.lit(i).alias("i"), F.when(v.isNotNull(), prints(v)).alias("p")) for i, v in enumerate(_texts(df, columns))]
    distinct = df.select(F.explode(F.array(*each)).alias("e")).select("e.i", "e.p").where("p is not null").distinct()
    counted = distinct.groupBy("i").agg(F.count(F.lit(1)).alias("n_distinct"))
    names = F.array(*[F.lit(c) for c in columns])
    return counted.select(F.element_at(names, F.col("i") + 1).alias("column"), "n_distinct")


def two_valued(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """The columns with exactly two distinct non-null values, in order.

    One pass of mergeable sketches leaves the few columns that may hold two;
    only their values, a handful each, are then collected exactly."""
    columns = list(columns or df.columns)
    texts = _texts(df, columns)
    sketch = df.agg(F.array(*[F.approx_count_distinct(v) for v in texts]).alias("n")).first()["n"]
    # a sketch of two values reads 2, or 1 where they share a register
    few = [i for i, n in enumerate(sketch) if 1 <= n <= 8]
    if not few:
        return []
    sizes = df.agg(F.array(*[F.size(F.collect_set(texts[i])) for i in few]).alias("n")).first()["n"]
    return [columns[i] for i, n in zip(few, sizes, strict=True) if n == 2]


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A4: most frequent non-null value per column; ties -> smallest value
    (pandas ``mode()[0]``).  Columns with no values are absent."""
    counted = (
        _long(df, list(columns)).where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    )
    # min(struct(-count, value)): highest count first, then smallest value;
    # an algebraic aggregate with partial combine, so no value list per task.
    best = counted.groupBy("column").agg(F.min(F.struct((-F.col("cnt")).alias("neg"), F.col("value"))).alias("b"))
    return best.select("column", F.col("b.value").alias("mode"), (-F.col("b.neg")).alias("mode_count"))


def stddevs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample standard deviation per column (null for < 2 values)."""
    columns = list(columns)
    wide = df.agg(_rows_of("std", [(c, F.stddev_samp(_known(df, c).cast("double"))) for c in columns]))
    return wide.select(F.explode("r").alias("r")).select("r.column", "r.std")


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, non-null, distinct,
    median (numeric), sample std (numeric), mode (string)."""
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)],
        "column string, dtype string, ordinal int",
    )
    prof = types.join(non_null_counts(df), "column").join(distinct_counts(df), "column", "left")
    nums = numeric_columns(df)
    strs = string_columns(df)
    if nums:
        prof = prof.join(column_quantiles(df, nums, out="median"), "column", "left")
        prof = prof.join(stddevs(df, nums), "column", "left")
    else:
        prof = prof.withColumn("median", F.lit(None).cast("double")).withColumn("std", F.lit(None).cast("double"))
    if strs:
        prof = prof.join(modes(df, strs).select("column", "mode"), "column", "left")
    else:
        prof = prof.withColumn("mode", F.lit(None).cast("string"))
    return prof.select(
        "column",
        "dtype",
        "ordinal",
        "n_rows",
        "non_null",
        F.coalesce(F.col("n_distinct"), F.lit(0)).cast("long").alias("n_distinct"),
        "median",
        "std",
        "mode",
    )


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """Class distribution, most frequent first (ties by value)."""
    vc = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        total = df.agg(F.count(F.lit(1))).scalar()  # scalar subquery, one value
        vc = vc.withColumn("share", F.col("count") / total)
    return vc.orderBy(F.col("count").desc(), F.col(col))


def corr_pairs(df: DataFrame, columns: Sequence[str], digits: int | None = 2) -> DataFrame:
    """A10: Pearson correlation for every pair a < b (column order), long form
    (a, b, r), over the rows where both are known; null where one is constant.

    Means come from one aggregate.  A second pass sums, per task, the products
    of all centred columns as matrices with masks for the missing values, so
    the plan grows with the columns and not with their pairs."""
    columns = list(columns)
    d = len(columns)
    if d < 2:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    x = F.array(*[_known(df, c).cast("double") for c in columns])
    means = df.agg(F.array(*[F.avg(_known(df, c).cast("double")) for c in columns]).alias("m")).first()["m"]

    def products(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        middle = np.array([0.0 if m is None else m for m in means])
        total = np.zeros((4, d, d))
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            known = ~np.isnan(values)
            v, m = np.where(known, values - middle, 0.0), known.astype("float64")
            total += np.stack([m.T @ m, v.T @ m, (v * v).T @ m, v.T @ v])
        i, j = np.triu_indices(d, 1)
        n, sums, squares, both = total
        cols = [i, j, n[i, j], sums[i, j], sums[j, i], squares[i, j], squares[j, i], both[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["i", "j", *parts])

    parts = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    kinds = "i long, j long, " + ", ".join(f"{p} double" for p in parts)
    s = df.select(x.alias("x")).mapInArrow(products, kinds).groupBy("i", "j").agg(*[F.sum(p).alias(p) for p in parts])
    spread = lambda sq, su: F.col(sq) - F.try_divide(F.col(su) * F.col(su), F.col("n"))
    vx, vy = spread("sxx", "sx"), spread("syy", "sy")
    # what rounding leaves of a constant column's spread is not a spread
    varies = (F.col("n") > 1) & (vx > F.col("sxx") * 1e-14) & (vy > F.col("syy") * 1e-14)
    r = F.when(varies, F.try_divide(F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n")), F.sqrt(vx * vy)))
    names = F.array(*[F.lit(c) for c in columns])
    at = lambda c: F.element_at(names, (F.col(c) + 1).cast("int"))
    return s.select(at("i").alias("a"), at("j").alias("b"), (r if digits is None else F.round(r, digits)).alias("r"))


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count/mean/std/min/max per numeric column (long form)."""
    cols = list(columns or numeric_columns(df))
    return (
        _long(df, cols, as_string=False)
        .groupBy("column")
        .agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
