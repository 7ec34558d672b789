"""Personal data by candidate gradient boosting [native].

Generators with high recall propose overlapping spans.  Proposals that a
strict pattern confirms (address syntax, octet range, check digit, number
length) are reported as base kinds.  For the others, boosted trees judge the
format and the context: they are fitted on all proposals of the corpus, where
confirmation by a strict pattern is the label and no feature repeats that
test.  Proposals of equal features are one weighted row.  A held-out fold
calibrates the margin; the threshold is the least margin above which
``PRECISION`` of the held-out proposals are confirmed.  The
trees become one column expression over the span, so texts are scored and
redacted in place: no span is moved to another task.

Defined results: null text -> no spans, and stays null when redacted; texts
without digits or @ cost one pattern pass; repeated rows are scanned each; an
empty table, or one with a single class of proposals, adds no spans.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import bind, let, pick
from lodestar.llm.spans import of_kind, overlaps_any, rendered, with_spans
from lodestar.operators.order_stats import running_sums
from lodestar.session import stage

KINDS = ("email", "ip", "card", "phone", "contact", "number")
BASE = 4
# The base patterns.  \G or the look-behind start a match only
# at the beginning of a run, where it would start anyway; possessive
# quantifiers keep long runs linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # wide generators
    "contact": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:@|\x20?[\(\[]at[\)\]]\x20?)[A-Za-z0-9.-]{3,}",
    "number": r"[+(]?[0-9][0-9().\x20/-]{5,}[0-9]",
}
PRECISION = 0.98
TREES, DEPTH = 10, 3
SEED = 17


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(v: Column) -> Column:
    """Whether the digits of the string pass the check-digit test."""
    d = F.split(F.reverse(_digits(v)), "")
    weighted = F.transform(
        F.filter(d, lambda c: c != ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")),
    )
    return F.aggregate(weighted, F.lit(0), lambda a, x: a + x) % 10 == 0


def _octets(v: Column) -> Column:
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return v.rlike(rf"^{part}\.{part}\.{part}\.{part}$")


VALID = {
    "ip": _octets,
    "card": lambda v: F.length(_digits(v)).between(12, 19) & luhn(v),
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}

FEATURES = ("digits", "length", "groups", "longest", "dots", "dashes", "spaces", "plus", "at", "letters", "glued", "cue", "distinct")
CUE = r"(?i)(?:mail|contact|phone|call|tel|mobile|fax|card|visa|account|ssn|address|whatsapp)[^\n]{0,12}$"


def features(s: Column) -> list[Column]:
    """Format and context of a proposal (value, left, right), in FEATURES order."""
    v, digits = s["value"], _digits(s["value"])
    runs = F.regexp_extract_all(v, F.lit("[0-9]+"), F.lit(0))
    cols = [
        F.length(digits),
        F.length(v),
        F.size(runs),
        F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0)),
        F.regexp_count(v, F.lit(r"\.")),
        F.regexp_count(v, F.lit("-")),
        F.regexp_count(v, F.lit(" ")),
        v.startswith("+").cast("int"),
        F.regexp_count(v, F.lit("@")),
        F.regexp_count(v, F.lit("[A-Za-z]")),
        (s["left"].rlike("[A-Za-z0-9]$") | s["right"].rlike("^[A-Za-z0-9]")).cast("int"),
        s["left"].rlike(CUE).cast("int"),
        F.size(F.array_distinct(F.split(digits, ""))),
    ]
    return [c.cast("double") for c in cols]


def propose(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its ``keep`` columns) as struct ``doc``, with ``text``, the
    confirmed spans ``base`` and the other proposals ``wide`` (with their value
    and context)."""
    keep = keep or docs.columns
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    d = with_spans(d, "text", PATTERNS, VALID)
    d = let(d, "base", F.concat(*[F.col(f"found.{k}") for k in KINDS[:BASE]]))
    wide = F.transform(
        F.concat(*[F.col(f"found.{k}") for k in KINDS[BASE:]]),
        lambda s: F.struct(
            s["start"],
            s["k"],
            s["end"],
            s["value"],
            F.substring(F.col("text"), F.greatest(s["start"] - 23, F.lit(1)), F.least(s["start"], F.lit(24))).alias("left"),
            F.substring(F.col("text"), s["end"] + 1, F.lit(2)).alias("right"),
            overlaps_any(s, F.col("base")).alias("confirmed"),
        ),
    )
    return let(d, "wide", wide).select("doc", "text", "base", "wide")


def tree_expression(debug: str, values: list[Column]) -> Column:
    """A regression tree's printed form as nested conditions."""
    lines = [x.strip() for x in debug.splitlines()[1:] if x.strip()]

    def node(i: int) -> tuple[Column, int]:
        if m := re.match(r"Predict: (\S+)", lines[i]):
            return F.lit(float(m[1])), i + 1
        m = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[i])
        low, i = node(i + 1)
        high, i = node(i + 1)  # skips the Else line
        return F.when(values[int(m[1])] <= float(m[2]), low).otherwise(high), i

    return node(0)[0]


class Judge:
    """Boosted trees as a column expression, with a calibrated threshold."""

    def __init__(self, trees: list[str], weights: list[float], threshold: float | None):
        self.trees, self.weights, self.threshold = trees, weights, threshold

    def margin(self, values: list[Column]) -> Column:
        return sum((tree_expression(t, values) * w for t, w in zip(self.trees, self.weights, strict=True)), F.lit(0.0))

    def accepts(self, span: Column) -> Column:
        if self.threshold is None:
            return F.lit(False)
        return self.margin(features(span)) >= F.lit(self.threshold)


def fit_judge(docs: DataFrame) -> Judge:
    """Fits the trees on all proposals, three of four (by hash of their context)
    to fit and the others to calibrate; equal ones count as often as they occur."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    found = propose(docs.select("text"), ["text"]).select(F.explode("wide").alias("s"))
    fold = F.pmod(F.xxhash64(F.lit(SEED), "s.left", "s.value", "s.right"), F.lit(4))
    each = found.select(fold.alias("fold"), F.col("s.confirmed").cast("double").alias("label"), *[f.alias(n) for f, n in zip(features(F.col("s")), FEATURES, strict=True)])
    counted = each.groupBy("fold", "label", *FEATURES).agg(F.count("*").cast("double").alias("n"))
    counted = stage(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(counted), "pii_proposals")
    fit, held = counted.where("fold > 0"), counted.where("fold = 0")
    classes = {r["label"] for r in fit.select("label").distinct().collect()}
    if len(classes) < 2:
        return Judge([], [], None)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, weightCol="n").fit(fit)
    judge = Judge([t.toDebugString for t in model.trees], list(model.treeWeights), None)
    # precision above each margin on the held-out fold; the least margin that
    # reaches PRECISION
    margins = held.select(F.round(judge.margin([F.col(n) for n in FEATURES]), 6).alias("m"), (F.col("label") * F.col("n")).alias("yes"), "n")
    steps = running_sums(margins.groupBy("m").agg(F.sum("yes").alias("yes"), F.sum("n").alias("n")), [F.desc("m")], ["yes", "n"])
    least = steps.where(F.col("cum_yes") / (F.col("cum_n") + 1) >= PRECISION).agg(F.min("m").alias("m")).first()["m"]
    judge.threshold = None if least is None else least - 1e-6
    return judge


def selected(proposed: DataFrame, judge: Judge) -> DataFrame:
    """Adds ``spans``: base spans, and the unconfirmed proposals that the
    judge accepts."""
    extra = F.filter("wide", lambda s: ~s["confirmed"] & judge.accepts(s))
    place = lambda s: F.struct(s["start"], s["k"], s["end"])
    spans = F.concat(F.transform("base", place), F.transform(extra, place))
    return let(proposed, "spans", spans).select("doc", "text", F.transform("base", place).alias("base"), "spans")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of
    overlapping spans the first names the place."""
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(marks, s["k"] + 1)
        )
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], piece).otherwise(acc["out"]).alias("out")
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(bind(F.aggregate(F.array_sort(spans), start, step), rest))


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with the text column redacted."""
    judge = fit_judge(docs)
    found = selected(propose(docs), judge)
    return found.select(
        *[
            F.when(F.col("doc.text").isNotNull(), redacted(F.col("text"), F.col("spans"))).alias("text") if c == "text" else F.col(f"doc.`{c}`")
            for c in docs.columns
        ]
    )


def op10_candidate_boosting(spark, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    docs = pick(spark.read.parquet(f"{sf_dir}/documents.parquet"), doc_id="doc_id", text="text")
    found = selected(propose(docs, ["doc_id"]), fit_judge(docs))
    base = F.col("base")
    return found.select(
        F.col("doc.doc_id").alias("doc_id"),
        *[of_kind(base, i).alias(f"n_{k}") for i, k in enumerate(KINDS[:BASE])],
        F.sha2(rendered(base, KINDS), 256).alias("base_sha256"),
        rendered(F.col("spans"), KINDS).alias("spans"),
    )
