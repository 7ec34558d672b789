"""Column builders and checks shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a maximal run of characters other than space, \t, \n, \v, \f, \r.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"


def words(text: str | Column) -> Column:
    """All words of the text in order; null and blank texts give an empty array."""
    parts = F.split(F.coalesce(_c(text), F.lit("")), SPACES)
    return F.filter(parts, lambda w: w != "")


def n_words(text: str | Column) -> Column:
    """Word count without building the word array twice; null gives 0."""
    return F.size(words(text)).cast("long")


def utf8_bytes(text: str | Column) -> Column:
    return F.coalesce(F.octet_length(_c(text)), F.lit(0)).cast("long")


def pick(df: DataFrame, **cols: str | Column) -> DataFrame:
    """Exactly the named columns, so extra input columns can never clash."""
    return df.select(*[_c(c).alias(n) for n, c in cols.items()])


def buckets_for(rows: int, per: int) -> int:
    return max(1, -(-rows // per))


def prefix_sum(df: DataFrame, within: Sequence[str], order: str, value: str, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` over ``order``, per ``within``.  For
    tables of bucket totals (already one row per bucket)."""
    from pyspark.sql import Window

    w = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))


def let(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with the column ``name``, computed once per row.  A generator is
    a barrier: the optimiser neither copies the expression into each use nor
    moves a filter on it below."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_starts(gaps: Column, lengths: Column, block: int = 256) -> Column:
    """Start of match i in the text: all gaps up to i plus all earlier matches.

    ``gaps[i]`` is the length of the text before match i (after match i-1).
    Done in blocks so a text with very many matches stays near linear."""

    def step(acc: Column, pair: Column) -> Column:
        return F.struct(
            (acc["end"] + pair["gap"] + pair["len"]).alias("end"),
            F.concat(acc["starts"], F.array(acc["end"] + pair["gap"])).alias("starts"),
        )

    def starts(pairs: Column) -> Column:
        def one_block(acc: Column, i: Column) -> Column:
            first = F.struct(acc["end"].alias("end"), F.expr("cast(array() as array<int>)").alias("starts"))
            return bind(
                F.aggregate(F.slice(pairs, i * block + 1, F.lit(block)), first, step),
                lambda inner: F.struct(inner["end"].alias("end"), F.concat(acc["all"], F.array(inner["starts"])).alias("all")),
            )

        last = F.floor(F.greatest(F.size(pairs) - 1, F.lit(0)) / block).cast("int")
        none = F.struct(F.lit(0).alias("end"), F.expr("cast(array() as array<array<int>>)").alias("all"))
        return F.flatten(F.aggregate(F.sequence(F.lit(0), last), none, one_block)["all"])

    pair = lambda g, m: F.struct(g.alias("gap"), m.alias("len"))
    return bind(bind(lengths, lambda n: F.zip_with(F.slice(gaps, 1, F.size(n)), n, pair)), starts)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
