"""Quality rules as a learned decision list [native].

Statistics of a text are column expressions.  From labelled documents,
sequential covering learns an ordered list of conjunctions of thresholds that
reject a document: a rule grows on the growing fold by the condition with the
largest information gain, loses its last conditions while that raises its
value on the pruning fold, and joins the list if its pruning-fold precision is
at least ``MIN_PRECISION``; the documents that it covers leave, and the next
rule grows.  The list is emitted as one ordered ``CASE WHEN`` expression.

Learning runs on counts that Spark aggregates per (statistic, threshold):
every labelled document counts, and the driver sees at most
statistics x thresholds rows a step.

Defined results: null and blank texts have no words and fail the base rule;
a document without a label or with conflicting labels teaches nothing; no
labels give an empty list, which keeps what passes the base rule; repeated
rows are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import bind, let, words
from lodestar.session import stage

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# learned statistics, each a ratio of the counts below
STATS = ("words", "symbol_ratio", "bang_ratio", "upper_ratio", "dup_line_ratio", "repeat_ratio", "word_length", "distinct_ratio")
THRESHOLDS = 48  # quantile borders tried per statistic
MAX_RULES = 12
MAX_CONDITIONS = 3
MIN_PRECISION = 0.95
MIN_COVER = 5  # rejected labelled documents of the growing fold per rule
MIN_GAIN = 1.0


def repeated_window_words(windows: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more in the array.

    Windows are sorted by (hash, place); equal neighbours are repeats; their
    places in order cover ``WINDOW`` words each, less the overlaps."""
    tagged = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeats(t: Column) -> Column:
        same = lambda x, i, by: F.coalesce(F.get(t, i + by)["h"] == x["h"], F.lit(False))
        return F.sort_array(
            F.transform(F.filter(t, lambda x, i: same(x, i, 1) | ((i > 0) & same(x, i, -1))), lambda x: x["i"])
        )

    def covered(places: Column) -> Column:
        following = F.slice(places, 2, F.greatest(F.size(places), F.lit(1)))
        steps = F.zip_with(places, following, lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)

    total = bind(bind(tagged, repeats), covered)
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), total).otherwise(F.lit(0))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc, q): the row of ``docs`` as a struct and the base counts of its
    text: n_words, word_chars, n_symbols, n_dup_lines, n_lines,
    n_repeat_words, n_upper, n_bang, n_distinct."""
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    body = F.coalesce(F.col(f"doc.`{text}`"), F.lit(""))
    d = let(d, "w", words(body))
    d = let(d, "h", F.transform("w", lambda w: F.xxhash64(w)))
    starts = F.slice("h", 1, F.greatest(F.size("h") - (WINDOW - 1), F.lit(0)))
    window = F.transform(starts, lambda h, i: F.xxhash64(h, *[F.get(F.col("h"), i + j) for j in range(1, WINDOW)]))
    d = let(d, "windows", window)
    d = let(d, "lines", F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    dropped = lambda pattern, size: size(body) - size(F.regexp_replace(body, pattern, ""))
    counts = {
        "n_words": F.size("w"),
        "word_chars": F.length(F.array_join("w", "")),
        "n_symbols": dropped(r"[#*$%&|<>]+", F.octet_length),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": repeated_window_words(F.col("windows")),
        "n_upper": dropped(r"\p{Lu}+", F.length),
        "n_bang": F.size(F.split(body, "!")) - 1,
        "n_distinct": F.size(F.array_distinct("h")),
    }
    d = let(d, "q", F.struct(*[c.cast("long").alias(k) for k, c in counts.items()]))
    return d.select("doc", "q")


def base_failed() -> Column:
    n, rep = F.col("q.n_words"), F.col("q.n_repeat_words")
    return (n < MIN_WORDS) | (rep * 100 > n * MAX_REPEAT_PERCENT)


def statistics() -> dict[str, Column]:
    c = lambda n: F.col(f"q.{n}").cast("double")
    per_word = lambda n: c(n) / F.greatest(c("n_words"), F.lit(1.0))
    return {
        "words": c("n_words"),
        "symbol_ratio": per_word("n_symbols"),
        "bang_ratio": per_word("n_bang"),
        "upper_ratio": c("n_upper") / F.greatest(c("word_chars"), F.lit(1.0)),
        "dup_line_ratio": c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1.0)),
        "repeat_ratio": per_word("n_repeat_words"),
        "word_length": per_word("word_chars"),
        "distinct_ratio": per_word("n_distinct"),
    }


@dataclass
class DecisionList:
    """Ordered rules; a rule is a list of (statistic, sign, threshold)."""

    rules: list[list[tuple[str, str, float]]] = field(default_factory=list)

    @staticmethod
    def holds(rule: list[tuple[str, str, float]], value: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, sign, cut in rule:
            out = out & ((value[name] > cut) if sign == ">" else (value[name] <= cut))
        return out

    def rejects(self, value: dict[str, Column]) -> Column:
        """Number of the first rule that holds (from 1); null if none does."""
        out = F.lit(None).cast("int")
        for i in range(len(self.rules), 0, -1):
            out = F.when(self.holds(self.rules[i - 1], value), i).otherwise(out)
        return out

    def sql(self) -> str:
        whens = "".join(
            f" WHEN {' AND '.join(f'{n} {s} {c!r}' for n, s, c in rule)} THEN {i}" for i, rule in enumerate(self.rules, 1)
        )
        return f"CASE{whens} END" if self.rules else "NULL"


def _cell(name: str, cuts: list[float]) -> Column:
    """How many borders lie below the value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda c: c < F.col(name)))


def fit_rules(labelled: DataFrame) -> DecisionList:
    """``labelled``: (bad boolean, fold int 0..2, STATS...).  Fold 0 prunes,
    the others grow."""
    rows = stage(labelled, "quality_labelled")
    probs = [i / (THRESHOLDS + 1) for i in range(1, THRESHOLDS + 1)]
    found = rows.where("bad").agg(*[F.percentile_approx(s, probs, 10_000).alias(s) for s in STATS]).first()
    also = rows.where("not bad").agg(*[F.percentile_approx(s, probs, 10_000).alias(s) for s in STATS]).first()
    cuts = {s: sorted(set(found[s] or []) | set(also[s] or [])) for s in STATS}
    value = {s: F.col(s) for s in STATS}
    out = DecisionList()

    def table(rule: list, grow: bool) -> tuple[dict, int, int]:
        """Per statistic, bad and good counts by cell between its borders,
        among the rows that no rule covers yet and this rule holds for."""
        at = rows.where(out.rejects(value).isNull() & DecisionList.holds(rule, value) & ((F.col("fold") > 0) if grow else (F.col("fold") == 0)))
        cell = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), _cell(s, cuts[s]).alias("i")) for s in STATS]))
        counts = at.select(cell.alias("c"), "bad").groupBy("c.s", "c.i").agg(F.sum(F.col("bad").cast("int")).alias("p"), F.count("*").alias("n"))
        got: dict[str, dict[int, tuple[int, int]]] = {s: {} for s in STATS}
        for r in counts.collect():
            got[r["s"]][r["i"]] = (r["p"], r["n"] - r["p"])
        first = got[STATS[0]].values()
        return got, sum(p for p, _ in first), sum(n for _, n in first)

    def grow() -> list:
        rule: list = []
        got, p0, n0 = table(rule, True)
        while len(rule) < MAX_CONDITIONS and p0 and n0:
            best = (MIN_GAIN, None, 0, 0)
            for s in STATS:
                p = n = 0
                for i, cut in enumerate(cuts[s]):
                    dp, dn = got[s].get(i, (0, 0))
                    p, n = p + dp, n + dn
                    for sign, a, b in (("<=", p, n), (">", p0 - p, n0 - n)):
                        if a >= MIN_COVER:
                            gain = a * (math.log2(a / (a + b)) - math.log2(p0 / (p0 + n0)))
                            best = max(best, (gain, (s, sign, cut), a, b), key=lambda x: x[0])
            if best[1] is None:
                break
            rule.append(best[1])
            if best[3] == 0:
                break
            got, p0, n0 = table(rule, True)
        return rule

    def pruned(rule: list) -> tuple[list, int, int]:
        """The rule without its last conditions as long as the pruning fold
        values it no less."""
        at = rows.where(out.rejects(value).isNull() & (F.col("fold") == 0))
        sums = []
        for k in range(1, len(rule) + 1):
            hold = DecisionList.holds(rule[:k], value)
            sums += [F.sum((hold & F.col("bad")).cast("int")).alias(f"p{k}"), F.sum((hold & ~F.col("bad")).cast("int")).alias(f"n{k}")]
        r = at.agg(*sums).first()
        worth = lambda k: ((r[f"p{k}"] or 0) - (r[f"n{k}"] or 0)) / max(1, (r[f"p{k}"] or 0) + (r[f"n{k}"] or 0))
        k = max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))
        return rule[:k], r[f"p{k}"] or 0, r[f"n{k}"] or 0

    while len(out.rules) < MAX_RULES:
        rule = grow()
        if not rule:
            break
        rule, p, n = pruned(rule)
        if p == 0 or p / (p + n) < MIN_PRECISION:
            break
        out.rules.append(rule)
    return out


def bad_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, bad) of the documents with one distinct quality, 0 (bad) or 1."""
    y = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("lo"), F.max("quality").alias("hi"))
    return y.where("lo = hi").select("doc_id", (F.col("lo") == 0).alias("bad"))


def learn(docs: DataFrame, labels: DataFrame) -> DecisionList:
    """The decision list from the labelled documents that pass the base rule."""
    counts = with_counts(docs.select("doc_id", "text")).select(F.col("doc.doc_id").alias("doc_id"), "q")
    return learn_from_counts(counts, bad_labels(labels))


def learn_from_counts(counts: DataFrame, bad: DataFrame) -> DecisionList:
    """The list from (doc_id, q) and (doc_id, bad): only counts are moved to
    meet the labels, never texts."""
    d = counts.where(~base_failed()).join(bad, "doc_id")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)).cast("int")
    return fit_rules(d.select("bad", fold.alias("fold"), *[c.alias(s) for s, c in statistics().items()]))


def quality_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass the base rule and no learned rule rejects."""
    rules = learn(docs, labels)
    judged = with_counts(docs)
    return judged.where(~base_failed() & rules.rejects(statistics()).isNull()).select("doc.*")


def op2_decision_list(spark, sf_dir: str) -> DataFrame:
    """Base counts and the verdict on every document, with the number of the
    learned rule that rejects it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counts = stage(with_counts(docs).select(F.col("doc.doc_id").alias("doc_id"), "q"), "quality_counts")
    rules = learn_from_counts(counts, bad_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return counts.withColumn("rule", rules.rejects(statistics())).select(
        "doc_id",
        *[F.col(f"q.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed().alias("base_failed"),
        (~base_failed() & F.col("rule").isNull()).alias("kept"),
        F.when(~base_failed(), F.col("rule")).alias("rule"),
    )
