"""Spans of patterns in texts, as column expressions.

A span is struct(start, k, end, value): code points, end exclusive, ``k`` the
position of its kind in the operator's list of kinds.  Matches are leftmost
and non-overlapping per pattern."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import let, running_starts

SPAN = "struct<start:int,k:int,end:int,value:string>"


def no_spans() -> Column:
    return F.expr(f"cast(array() as array<{SPAN}>)")


def with_spans(df: DataFrame, text: str, patterns: dict[str, str], valid: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Adds ``found``, a struct with the spans of each pattern; spans whose
    value is not valid are dropped after matching, without another try."""
    df = let(df, "matched", F.struct(*[F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(k) for k, p in patterns.items()]))
    spans = [located(F.col(text), F.col(f"matched.{k}"), p, i, valid.get(k)).alias(k) for i, (k, p) in enumerate(patterns.items())]
    return let(df, "found", F.struct(*spans)).drop("matched")


def located(text: Column, matches: Column, pattern: str, k: int, valid: Callable[[Column], Column] | None = None) -> Column:
    """The spans of the matches.  The text between them (a split by the same
    pattern) gives their places; texts without a match are not split."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    starts = running_starts(gaps, F.transform(matches, F.length))
    spans = F.zip_with(
        starts,
        matches,
        lambda s, m: F.struct(
            s.cast("int").alias("start"), F.lit(k).alias("k"), (s + F.length(m)).cast("int").alias("end"), m.alias("value")
        ),
    )
    if valid is not None:
        spans = F.filter(spans, lambda s: valid(s["value"]))
    return F.when(F.size(matches) > 0, spans).otherwise(no_spans())


def rendered(spans: Column, kinds: Sequence[str]) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["k"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def of_kind(spans: Column, k: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["k"] == k)).cast("long")


def overlaps_any(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))
