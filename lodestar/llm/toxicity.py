"""Toxicity scores from a learned lexicon, misspellings and context.

Lexicon: words, and word beginnings of four to six letters, that occur in many
different contexts of toxic training documents and hardly in clean ones
(one context a document, so copies of a text and repeated lines teach once).  A word of a
text matches a term if it lies within the term's edit distance: the word's
Levenshtein automaton is run over the trie of all terms, so one walk finds all
terms near it.  Distinct words are looked up once per task, and only words
that share a deletion variant with a term are walked.

Context: a hit in quotation marks or after a verb of saying counts as quoted.
A logistic regression on the documents' weighted sums of plain and quoted
hits, their number and their share gives the score.

The model is fitted on at most ``FIT_DOCS`` labelled documents of each class
(the first by hash), all with crc32(doc_id) mod 4 other than 2; scoring covers
every whole text.

Defined results: null and blank texts have no hits and get the score of such
texts; without labels of both classes every score is 0; documents with
conflicting labels teach nothing; a null id is not held out; repeated rows are
scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import pick
from lodestar.session import stage

FIT_DOCS = 2_000
MIN_CONTEXTS = 5
MIN_RATIO = 20.0  # contexts per toxic against clean document
MAX_TERMS = 5_000
STEMS = (4, 5, 6)
THRESHOLD = 0.3
WINDOW = 4  # words before a hit that can make it a quotation
SEED = 23
MEMO = 600_000

WORD = re.compile(r"[^\W\d_]+")
# fixed values: verbs of saying and quotation marks of the four languages
SAYING = frozenset(
    "said says say called calls wrote quoted quote sagte sagt nannte schrieb zitat dit disait appelé écrit dijo dice llamó escribió".split()
)
OPENING, CLOSING = "\"'“„«‹‘", "\"'”“»›’"


def reach(term: str) -> int:
    """Edits allowed in a term: short ones must match exactly."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class LevenshteinAutomaton:
    """Accepts strings within ``k`` edits of a word.  A state is the row of
    edit distances to all beginnings of the word, cut off above k; states are
    numbered and transitions kept as they are first taken."""

    def __init__(self, word: str, k: int):
        self.word, self.k = word, k
        self.start = tuple(min(i, k + 1) for i in range(len(word) + 1))
        self._next: dict[tuple, tuple | None] = {}

    def step(self, row: tuple, c: str) -> tuple | None:
        """The next state, or None when nothing can be accepted any more."""
        key = (row, c)
        if key not in self._next:
            new, over = [min(row[0] + 1, self.k + 1)], self.k + 1
            for i, w in enumerate(self.word, 1):
                new.append(min(row[i - 1] + (w != c), row[i] + 1, new[i - 1] + 1, over))
            self._next[key] = tuple(new) if min(new) <= self.k else None
        return self._next[key]

    def distance(self, row: tuple) -> int:
        return row[-1]


def deletions(word: str, k: int) -> set[str]:
    out = last = {word}
    for _ in range(k):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out = out | last
    return out


class Lexicon:
    """Whole terms in a trie (edits allowed) and stems (exact beginnings)."""

    def __init__(self, terms: list[str]):
        self.whole = [t for t in terms if not t.endswith("*")]
        self.stems = {t[:-1] for t in terms if t.endswith("*")}
        self.trie: dict = {}
        self._near: list[set[str]] = [set(), set(), set()]
        for t in self.whole:
            node = self.trie
            for c in t:
                node = node.setdefault(c, {})
            node[""] = t
            for k in range(1, reach(t) + 1):
                self._near[k] |= deletions(t, k)
        self._exact = set(self.whole)

    def find(self, word: str) -> tuple[str, int] | None:
        """The nearest term (then the first by code points) and its distance;
        else the longest stem that the word begins with."""
        if word in self._exact:
            return word, 0
        best = None
        # edits of one or two: a shared deletion variant is necessary
        if self._near[1] and 4 <= len(word) <= 40 and not self._near[1].isdisjoint(deletions(word, 1)):
            best = self._walk(word, 1)
        if best is None and self._near[2] and 7 <= len(word) <= 40 and not self._near[2].isdisjoint(deletions(word, 2)):
            best = self._walk(word, 2)
        if best is None:
            for n in sorted(STEMS, reverse=True):
                if word[:n] in self.stems and len(word) >= n:
                    return word[:n] + "*", 0
        return best

    def _walk(self, word: str, k: int) -> tuple[str, int] | None:
        machine, best = LevenshteinAutomaton(word, k), None
        todo = [(self.trie, machine.start)]
        while todo:
            node, row = todo.pop()
            for c, child in node.items():
                if c == "":
                    d = machine.distance(row)
                    if d <= min(k, reach(child)) and (best is None or (d, child) < (best[1], best[0])):
                        best = (child, d)
                elif (new := machine.step(row, c)) is not None:
                    todo.append((child, new))
        return best


class _Memo(dict):
    def __init__(self, find):
        super().__init__()
        self._find = find

    def __missing__(self, word: str):
        if len(self) >= MEMO:
            self.clear()
        found = self._find(word)
        if len(word) <= 64:
            self[word] = found
        return found


def is_quoted(text: str, start: int, end: int) -> bool:
    """Whether the hit stands in quotation marks that open just before it or
    within its window, or follows a verb of saying there."""
    left, right = text[max(0, start - 60) : start], text[end : end + 60]
    before = WORD.findall(left.lower())[-WINDOW:]
    if any(w in SAYING for w in before):
        return True
    opened = max((left.rfind(c) for c in OPENING), default=-1)
    if opened < 0 or left[opened - 1 : opened].isalnum():
        return False
    closed = any(c in left[opened + 1 :] for c in CLOSING)
    return not closed and len(WORD.findall(left[opened:])) <= WINDOW and any(c in right for c in CLOSING)


FEATURES = ("plain", "quoted", "hits", "share")


def document_features(text: str, find, weight: dict[tuple[str, int], float]) -> tuple[float, float, float, float]:
    low = text.lower()
    if len(low) != len(text):
        text = low  # places must agree
    words = WORD.findall(low)
    hits = [m for m in map(find, words) if m is not None]
    if not hits:
        return 0.0, 0.0, 0.0, 0.0
    plain = quoted = 0.0
    for m in WORD.finditer(low):
        got = find(m.group())
        if got is not None:
            w = max(weight.get(got, 0.0), 0.0)
            if is_quoted(text, m.start(), m.end()):
                quoted += w
            else:
                plain += w
    return math.log1p(plain), math.log1p(quoted), math.log1p(len(hits)), min(1.0, 10 * len(hits) / len(words))


@dataclass
class Model:
    terms: list[str]
    weight: dict[tuple[str, int], float]
    coefficients: list[float]
    intercept: float | None

    def scores(self, texts: list[str | None], find) -> list[float]:
        out = []
        for t in texts:
            if self.intercept is None:
                out.append(0.0)
                continue
            x = document_features(t or "", find, self.weight)
            z = self.intercept + sum(a * b for a, b in zip(self.coefficients, x, strict=True))
            out.append(1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, z)))))
        return out


def _counts(sample: DataFrame, schema: str, run) -> DataFrame:
    return sample.select("toxic", "text").mapInArrow(run, schema)


def contexts(sample: DataFrame) -> DataFrame:
    """(term, toxic, clean): in how many different contexts (the words beside
    it) each candidate term occurs.  A document gives one context of each
    term, the least: neither a text that repeats a word nor copies of one text
    count more than once."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows: list[tuple[str, int, str]] = []
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = ["", *WORD.findall((text or "").lower()), ""]
                least: dict[str, str] = {}
                for i in range(1, len(words) - 1):
                    w = words[i]
                    if 3 <= len(w) <= 40:
                        beside = f"{words[i - 1]} {words[i + 1]}"
                        for term in (w, *(f"{w[:n]}*" for n in STEMS if len(w) > n)):
                            if beside < least.get(term, "\U0010ffff"):
                                least[term] = beside
                rows += [(term, toxic, beside) for term, beside in least.items()]
            cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.int32(), pa.string()))]
            yield pa.RecordBatch.from_arrays(cols, names=["term", "toxic", "beside"])

    found = _counts(sample, "term string, toxic int, beside string", run)
    found = found.select("term", "toxic", F.xxhash64("beside").alias("beside")).distinct()
    return found.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> Model:
    """``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    y = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("toxic").alias("lo"), F.max("toxic").alias("hi"))
    mine = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2
    y = y.where("lo = hi").where(mine).select("doc_id", F.col("lo").cast("int").alias("toxic"))
    order = [F.xxhash64(F.lit(SEED), "doc_id"), F.col("doc_id")]
    chosen = None
    for c in (0, 1):
        part = y.where(F.col("toxic") == c).orderBy(*order).limit(fit_docs)
        chosen = part if chosen is None else chosen.union(part)
    chosen = stage(chosen, "tox_labels")
    # at most 2 * fit_docs rows
    sample = docs.join(F.broadcast(chosen), "doc_id").withColumn("of", F.xxhash64("text")).dropDuplicates(["of", "toxic"])
    sample = stage(sample.orderBy("of", "toxic").limit(4 * fit_docs).select("doc_id", "toxic", "text"), "tox_sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    totals = {r["toxic"]: r["n"] for r in y.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    none = Model([], {}, [0.0] * len(FEATURES), None)
    if len(sizes) < 2:
        return none
    n1, n0 = sizes[1], sizes[0]
    lift = (F.col("toxic") / F.lit(n1)) / ((F.col("clean") + 0.5) / F.lit(n0))
    terms = contexts(sample).where((F.col("toxic") >= MIN_CONTEXTS) & (lift >= MIN_RATIO))
    found = [r["term"] for r in terms.orderBy(F.desc("toxic"), "term").limit(MAX_TERMS).collect()]
    if not found:
        return none

    def hits(batches: Iterator) -> Iterator:
        import pyarrow as pa

        memo = _Memo(Lexicon(found).find)
        for batch in batches:
            rows = []
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen = {m for m in map(memo.__getitem__, WORD.findall((text or "").lower())) if m is not None}
                rows += [(t, d, toxic) for t, d in seen]
            cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.int32(), pa.int32()))]
            yield pa.RecordBatch.from_arrays(cols, names=["term", "edits", "toxic"])

    per = _counts(sample, "term string, edits int, toxic int", hits).groupBy("term", "edits")
    per = per.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    # at most MAX_TERMS x 3 rows; two clean documents more, so that terms with
    # little evidence weigh less
    weight = {(r["term"], r["edits"]): math.log((r["t"] + 0.5) / (n1 + 1)) - math.log((r["c"] + 2) / (n0 + 1)) for r in per.collect()}

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        find = _Memo(Lexicon(found).find).__getitem__
        for batch in batches:
            x = [document_features(t or "", find, weight) for t in batch.column(1).to_pylist()]
            cols = [pa.array([r[i] for r in x], pa.float64()) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["toxic", *FEATURES])

    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    x = _counts(sample, "toxic int, " + ", ".join(f"{f} double" for f in FEATURES), run)
    # the sample is balanced; weights restore the shares of all labels
    scale = {c: totals[c] / sizes[c] for c in (0, 1)}
    x = x.withColumn("weight", F.when(F.col("toxic") == 1, F.lit(float(scale[1]))).otherwise(F.lit(float(scale[0]))))
    x = stage(VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(x).withColumn("y", F.col("toxic").cast("double")), "tox_features")
    lr = LogisticRegression(featuresCol="x", labelCol="y", weightCol="weight", regParam=0.001, maxIter=50).fit(x)
    return Model(found, weight, [float(c) for c in lr.coefficients], float(lr.intercept))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) per document."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        find = _Memo(Lexicon(model.terms).find).__getitem__
        for batch in batches:
            scores = model.scores(batch.column(1).to_pylist(), find)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def op5_levenshtein_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents, by a model of the training rows' labels."""
    docs = pick(spark.read.parquet(f"{sf_dir}/documents.parquet"), doc_id="doc_id", text="text")
    scored = score_documents(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
