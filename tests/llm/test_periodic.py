"""Periodic runs against plain enumeration."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestar.llm import periodic
from lodestar.llm.periodic import COVER, COVER_PERIOD, op11_periodic_runs, periodic_runs

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_runs(w, min_length=6, min_exponent=4):
    """Every maximal stretch of period p, kept under its smallest period."""
    best = {}
    for p in range(1, len(w) // min_exponent + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(min_length, min_exponent * p):
                best.setdefault((i, j + p - i), p)
            i = j
    return sorted(((s, n, p) for (s, n), p in best.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(w)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    milli = 1000 * top[1] // top[2] if runs else None
    return (doc_id, len(runs), *top, milli, sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(kept))


def numbered(docs):
    """The layout of find_runs: an ending id, then words and ending id of each document."""
    lengths = np.array([len(d) for d in docs])
    starts = np.cumsum(lengths + 1) - lengths
    flat, owner, end = [100], [0], 101
    for k, d in enumerate(docs):
        flat += [*d, end]
        owner += [k + 1] * (len(d) + 1)
        end += 1
    return np.array(flat), starts, lengths, np.array(owner)


def test_cover_has_every_difference():
    assert {(a - b) % COVER_PERIOD for a in COVER for b in COVER} == set(range(COVER_PERIOD))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), min_size=1, max_size=4), st.integers(1, 9), st.integers(0, 40))
def test_runs_equal_enumeration(docs, times, lead):
    docs = docs + [docs[0][:lead] + docs[-1] * times]
    words, starts, lengths, owner = numbered(docs)
    got = list(zip(*(x.tolist() for x in periodic.find_runs(words, starts, lengths, owner)), strict=True))
    want = [(s + starts[k], n, p) for k, d in enumerate(docs) for s, n, p in plain_runs(d)]
    assert got == want


def test_extensions_equal_comparison():
    rng = np.random.default_rng(3)
    unit = rng.integers(0, 4, 60).tolist()
    words, starts, lengths, owner = numbered([unit * 8, rng.integers(0, 2, 300).tolist()])
    lce = periodic.CommonExtensions(words, owner)
    for d in range(2):
        x, y = np.triu_indices(lengths[d], 1)
        x, y = x[:: 37] + starts[d], y[:: 37] + starts[d]

        def plain(a, b):
            n = 0
            while words[a + n] == words[b + n]:
                n += 1
            return n

        assert lce.extend(x, y).tolist() == [plain(a, b) for a, b in zip(x, y, strict=True)]


def test_small_blocks_change_nothing(monkeypatch):
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, 2, 400).tolist(), [1] * 200, rng.integers(0, 30, 50).tolist() * 6]
    want = [x.tolist() for x in periodic.find_runs(*numbered(docs))]
    monkeypatch.setattr(periodic, "PAIRS", 7)
    assert [x.tolist() for x in periodic.find_runs(*numbered(docs))] == want


def rows_of(df):
    cols = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_query_on_odd_texts(spark, make_docs, sf_of):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    texts = [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a"), (5, "a a a a a"), (6, "a a a a a a"), (6, "a a a a a a"), (7, "x " + "a b " * 5 + "c"),
        (8, "             "), (9, long), (11, "é ß\tü\né ß ü é ß ü é ß ü é"), *[(i, " ".join(f"v{j * j % 17}" for j in range(i))) for i in ids],
    ]
    docs = make_docs(texts, extra=("runs", "collapsed", "row"))
    got = rows_of(op11_periodic_runs(spark, sf_of(documents=docs)))
    assert got == sorted(plain_row(*t) for t in texts)


def test_query_on_driver_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = rows_of(op11_periodic_runs(spark, sf))
    assert got == sorted(plain_row(r["doc_id"], r["text"]) for r in texts)
    assert sum(r[1] for r in got) > 10


@pytest.mark.parametrize("group", [1, 50, 10_000])
def test_operator_keeps_texts_and_rows(spark, make_docs, monkeypatch, group):
    monkeypatch.setattr(periodic, "GROUP", group)
    docs = make_docs([(1, "spam " * 9 + "end"), (2, None), (1, "spam " * 9 + "end"), (3, "one two three")])
    got = sorted((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs(docs).collect())
    assert got == [(1, [(0, 9, 1)], "spam end"), (1, [(0, 9, 1)], "spam end"), (2, [], ""), (3, [], "one two three")]


def test_empty_table(spark, make_docs, sf_of):
    assert rows_of(op11_periodic_runs(spark, sf_of(documents=make_docs([])))) == []
