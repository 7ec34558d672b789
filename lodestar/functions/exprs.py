"""Null-safe column builders.

All are built-in Catalyst expressions, so they stay inside whole-stage
codegen; none is a Python UDF.  Each encodes one pandas semantic explicitly
(NaN/None handling, coercion, defaults) so that results match row for row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


INFINITY = float("inf")


def known(c: str | Column) -> Column:
    """False for NaN, which Spark orders above every number, and null for null;
    for numbers of any kind."""
    return col_(c) <= F.lit(INFINITY)


def no_nan(c: str | Column) -> Column:
    """The number with NaN as null: pandas holds both for missing."""
    c = col_(c)
    return F.when(known(c), c)


# The filters are plain conjunctions of comparisons, so that each bound reaches
# the scan; ``is not null`` makes a null false instead of null.
def between_exclusive(c, lo, hi) -> Column:
    """``lo < c < hi``; null and NaN never pass (NaN is above ``hi``)."""
    c = col_(c)
    return c.isNotNull() & (c > F.lit(lo)) & (c < F.lit(hi))


def between_inclusive(c, lo, hi) -> Column:
    """P5: ``Series.between(lo, hi)``; null and NaN never pass."""
    c = col_(c)
    return c.isNotNull() & (c >= F.lit(lo)) & (c <= F.lit(hi))


def positive(c) -> Column:
    """``c > 0``; null and NaN never pass."""
    c = col_(c)
    return c.isNotNull() & (c > F.lit(0)) & known(c)


def isin_flag(c, values: Iterable) -> Column:
    """Membership -> 0/1 (null -> 0)."""
    return F.coalesce(col_(c).isin(list(values)), F.lit(False)).cast("int")


def threshold_flag(c, threshold, op: str = ">=") -> Column:
    """Comparison of numbers -> 0/1; with a null or NaN it is 0 like pandas."""
    c, t = col_(c), threshold if isinstance(threshold, Column) else F.lit(threshold)
    cmp = {">=": c >= t, ">": c > t, "<=": c <= t, "<": c < t}[op]
    # NaN would win against any number on the larger side
    larger = c if op in (">=", ">") else t
    return F.coalesce(cmp & known(larger), F.lit(False)).cast("int")


def clip(c, lo, hi) -> Column:
    """P10: pandas ``clip`` keeps missing values; ``greatest``/``least`` would
    skip them, so the case is explicit."""
    c = col_(c)
    return F.when(known(c), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def bucket(c, cuts: list[tuple[float, str]], default: str) -> Column:
    """CASE bucketing, first matching ``c >= cut`` wins (cuts descending);
    null and everything below -> ``default``."""
    c = col_(c)
    expr = None
    for cut, label in cuts:
        cond = c >= F.lit(cut)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def ratio(num, den) -> Column:
    """``num / den`` as double; a zero or null denominator gives null
    (ANSI mode would raise on plain division)."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def log1p(c) -> Column:
    """P13."""
    return F.log1p(col_(c).cast("double"))


def text_length(c) -> Column:
    """Character length with null -> "" (length 0)."""
    return F.char_length(F.coalesce(col_(c), F.lit("")))


def occurrences(c, sub: str) -> Column:
    """Non-overlapping occurrences of a literal substring (no array built)."""
    c = col_(c)
    return ((F.char_length(c) - F.char_length(F.replace(c, F.lit(sub), F.lit("")))) / F.lit(len(sub))).cast("int")


def token_count(c, sep: str = "|", none_marker: str = "[none]") -> Column:
    """``len(t.split(sep))`` (= separators + 1) for a non-empty tokens
    string; "" or the none-marker or null -> 0."""
    c = col_(c)
    return (
        F.when(c.isNull() | (c == F.lit("")) | (c == F.lit(none_marker)), F.lit(0))
        .otherwise(occurrences(c, sep) + F.lit(1))
        .cast("int")
    )


def line_count(c) -> Column:
    """Lines of a text: newlines + 1 (``len(t.split("\\n"))``); null stays null."""
    return (occurrences(c, "\n") + F.lit(1)).cast("int")


# Fixed word definition: a maximal run of characters other than
# space, tab, newline, carriage return and form feed.
WORD_PATTERN = "[^ \t\n\r\f]+"


def word_count(c) -> Column:
    """Word count of the whole text (0 for null/blank), without splitting."""
    return F.coalesce(F.regexp_count(col_(c), F.lit(WORD_PATTERN)), F.lit(0)).cast("int")


def parse_ts(c, fmt: str | None = None) -> Column:
    """Coerce a string to a UTC timestamp; unparsable -> null."""
    c = col_(c)
    if fmt:
        return F.try_to_timestamp(c.cast("string"), F.lit(fmt))
    return F.try_to_timestamp(c.cast("string"))


def hour_or(c, default: int = 12) -> Column:
    """Hour of a timestamp, default when null."""
    return F.coalesce(F.hour(col_(c)), F.lit(default)).cast("int")


def weekday_or(c, default: int = 0) -> Column:
    """Day of week with Monday = 0 (pandas ``dayofweek``), default when null."""
    return F.coalesce(F.weekday(col_(c)), F.lit(default)).cast("int")


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip every string column, of any white space like ``str.strip``."""
    return df.select(
        *[
            stripped(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\s\u00a0\u0085\x1c-\x1f]+|[\s\u00a0\u0085\x1c-\x1f]+$", "")


def to_number(c) -> Column:
    """P20: ``to_numeric(errors="coerce")``: bad text and ``nan`` -> null.  The
    kind of the column is a constant of the plan, so a number is only cast."""
    c = col_(c)
    number = F.typeof(c).isin("tinyint", "smallint", "int", "bigint", "double")
    return no_nan(F.when(number, c.try_cast("double")).otherwise(stripped(c.cast("string")).try_cast("double")))


def boolish(c, unknown_as_zero: bool = False) -> Column:
    """True/"True" -> 1, False/"False" -> 0; anything else -> null
    (targets) or 0 (features, ``.fillna(0)``)."""
    c = col_(c)
    s = c.cast("string")  # a boolean column reads true / false here
    yes, no = ("True", "true"), ("False", "false")
    spelled = F.typeof(c) == F.lit("string")
    out = F.when((s == yes[0]) | (~spelled & (s == yes[1])), F.lit(1)).when((s == no[0]) | (~spelled & (s == no[1])), F.lit(0))
    return (out.otherwise(F.lit(0)) if unknown_as_zero else out).cast("int")


def fill_default(c, default) -> Column:
    """``fillna(default)``."""
    return F.coalesce(col_(c), F.lit(default))


def lookup(df: DataFrame, key: str, dim: DataFrame, dim_key: str, dim_val: str, out: str, fallback_fmt: str) -> DataFrame:
    """Code -> label through a dimension table, with a formatted
    fallback (``Category {code}``) for unknown codes.  The dimension is a
    dictionary: it is broadcast when the optimiser measures it small."""
    d = dim.select(F.col(dim_key).alias("_lk"), F.col(dim_val).alias("_lv"))
    joined = df.join(d, df[key] == d["_lk"], "left")
    fb = F.format_string(fallback_fmt, F.col(key))
    return joined.withColumn(out, F.coalesce(F.col("_lv"), fb)).drop("_lk", "_lv")


def display_label(c, labels: Mapping[int, str]) -> Column:
    """P25: 0/1 -> display text."""
    c = col_(c)
    expr = None
    for k, v in labels.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr


def percent(c, digits: int = 1) -> Column:
    """P25: probability x 100, rounded."""
    return F.round(col_(c) * F.lit(100.0), digits)


def per_thousand_to_rate(c) -> Column:
    """User-unit conversion (per-1000 count -> rate)."""
    return col_(c).cast("double") / F.lit(1000.0)
