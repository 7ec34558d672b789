"""Operator 5: automaton against plain edit distances, held-out accuracy."""

import random
import zlib

from lodestar.llm import toxicity
from lodestar.llm.toxicity import LevenshteinAutomaton, Lexicon, is_quoted, op5_levenshtein_toxicity, reach


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_automaton_and_trie_against_distances():
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcé", k=rng.randint(1, 11)))
    terms = sorted({word() for _ in range(60)})
    lexicon = Lexicon(terms)
    for _ in range(3_000):
        w = word()
        near = [(distance(w, t), t) for t in terms if distance(w, t) <= reach(t)]
        exact = [t for d, t in near if d == 0]
        want = (exact[0], 0) if exact else None
        for k, least in ((1, 4), (2, 7)):
            if want is None and len(w) >= least:
                close = [(d, t) for d, t in near if d <= k]
                want = (min(close)[1], min(close)[0]) if close else None
        assert lexicon.find(w) == want, (w, near)
    machine = LevenshteinAutomaton("abc", 1)
    row = machine.start
    for c in "xyz":
        row = machine.step(row, c) if row else None
    assert row is None


def test_quotation():
    t = 'he said idiot. She is an idiot! The word "stupid idiot" here; don\'t be an idiot it\'s'
    places = [i for i in range(len(t)) if t.startswith("idiot", i)]
    assert [is_quoted(t, i, i + 5) for i in places] == [True, False, True, False]


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out(spark):
    """On the table whose labels are enough for words of four languages."""
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in op5_levenshtein_toxicity(spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    y = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r["held_out"] == held(i) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for i, r in got.items())
    pairs = [(y[i], r["predicted"]) for i, r in got.items() if r["held_out"] and i in y]
    hit = sum(1 for a, b in pairs if a == b == 1)
    assert hit / sum(a for a, _ in pairs) >= 0.8
    assert hit / max(1, sum(b for _, b in pairs)) >= 0.9


def test_labels_of_held_out_rows_are_not_read(spark, make_docs, sf_of):
    rows = [(i, f"word{i % 7} some text abusive{'' if i % 3 else 'x'} end{i}" if i % 2 else f"quiet words {i} here") for i in range(200)]
    labels = [(i, i % 2) for i in range(200)]
    flipped = [(i, 1 - t if held(i) else t) for i, t in labels]
    out = []
    for lab in (labels, flipped):
        sf = sf_of(documents=make_docs(rows), labels=spark.createDataFrame(lab, "doc_id long, toxic int"))
        out.append(sorted(map(tuple, op5_levenshtein_toxicity(spark, sf).collect())))
    assert out[0] == out[1]


def test_hard_rows(spark, make_docs, sf_of):
    rows = [(1, None), (2, ""), (3, "x " * 40_000 + "İ"), (None, "idiot"), (4, "a"), (4, "a")]
    for labels in ([], [(1, 1), (2, 0)], [(2, 0), (2, 1), (4, 1), (None, 1), (3, None)]):
        sf = sf_of(
            documents=make_docs(rows, extra=("toxic", "score", "of")), labels=spark.createDataFrame(labels, "doc_id long, toxic int")
        )
        got = op5_levenshtein_toxicity(spark, sf).collect()
        assert len(got) == 6 and all(r["score"] == 0 and r["predicted"] == 0 for r in got)
    sf = sf_of(documents=make_docs([]), labels=spark.createDataFrame([], "doc_id long, toxic int"))
    assert op5_levenshtein_toxicity(spark, sf).count() == 0
    assert toxicity.document_features("", {}.get, {}) == (0.0, 0.0, 0.0, 0.0)
