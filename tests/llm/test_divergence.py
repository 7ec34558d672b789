"""Source divergence against plain counting and the SQL form."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, duck

from lodestar.llm import divergence
from lodestar.llm.divergence import OP13_SQL, PerfectHash, build_hash, hashes, op13_perfect_hash_recount, source_divergence, terms

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, min_docs=10, top=10):
    """rows: (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    docs, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = TERM.findall(text.translate(LOWER))
        docs[lang].update(set(found))
        count[lang, source].update(found)
        count[lang, None].update(found)
    out = []
    for lang in {r[0] for r in rows}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = {r[1] for r in rows if r[0] == lang}
        p = {}
        for s in [*sources, None]:
            total = sum(count[lang, s][t] for t in kept)
            p[s] = {t: 1 + 10**9 * (count[lang, s][t] + 2) // (total + 2 * len(kept)) for t in kept}
        far = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(far(p[s][t], p[o][t]) for t in kept)) for o in sources - {s}]
            own = [(t, far(p[s][t], p[None][t])) for t in kept if count[lang, s][t] and p[s][t] > p[None][t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", own, top)):
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(items[:most])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_terms_by_bytes_equal_the_pattern(text):
    text = text.encode("utf-8", "ignore").decode()
    assert [t.decode() for t in terms(text.encode())] == TERM.findall(text.translate(LOWER))


@pytest.mark.parametrize("n", [1, 2, 3, 17, 2000])
def test_perfect_hash_is_minimal_and_knows_its_keys(n):
    keys = [f"k{i}".encode() for i in range(n)]
    table = PerfectHash(*build_hash(keys))
    assert sorted(table.places(keys, hashes(keys)).tolist()) == list(range(n))
    strangers = [f"x{i}".encode() for i in range(5000)]
    assert set(table.places(strangers, hashes(strangers)).tolist()) == {-1}


def corpus(seed=1, n=150):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("Ab", "cé", "日本", "x") for b in "abcdefghij"]
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["a", "b", "c", "é", None])
        weights = [1 + (hash_of(w, source) % 7) for w in vocabulary]
        rows.append((lang, source, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(40)))))
    rows += [("xx", "lonely", None), ("yy", "p", "few terms"), ("yy", "q", ""), ("yy", None, "!!")]
    return rows + rows[:10]


def hash_of(word, source):
    return sum(map(ord, f"{word}{source}"))


def frame(spark, rows):
    return spark.createDataFrame([(*r, i, "x", 1) for i, r in enumerate(rows)], "lang string, source string, text string, doc_id long, term string, shard int")


def test_equals_plain_counting(spark, sf_of):
    rows = corpus()
    want = plain(rows)
    assert {r[2] for r in want} == {"pair", "term"} and any(r[0] == "xx" or r[0] == "yy" for r in want)
    assert rows_of(op13_perfect_hash_recount(spark, sf_of(documents=frame(spark, rows)))) == want


def test_shards_passes_and_tiles_change_nothing(spark, monkeypatch):
    rows = corpus(2)
    monkeypatch.setattr(divergence, "SHARD", 5)
    monkeypatch.setattr(divergence, "SHIPPED", 200)
    monkeypatch.setattr(divergence, "SLOTS", 6)
    monkeypatch.setattr(divergence, "HELD", 4)
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "FAN", 2)
    assert rows_of(source_divergence(frame(spark, rows).repartition(5))) == plain(rows)


def test_parameters(spark):
    rows = corpus(3)
    assert rows_of(source_divergence(frame(spark, rows), min_docs=3, top=2)) == plain(rows, 3, 2)


def test_very_long_text_and_hot_group(spark):
    rows = [("en", "hot", "spam ham " * 50_000)] * 3 + [("en", "hot", "ham eggs")] * 12 + [("en", "cold", "eggs ham spam")] * 10
    assert rows_of(source_divergence(frame(spark, rows))) == plain(rows)


def test_empty_table(spark, sf_of):
    assert rows_of(op13_perfect_hash_recount(spark, sf_of(documents=frame(spark, [])))) == []


@pytest.mark.parametrize("n", [0, 5, 9_223_372_034, 10**13 + 7])
def test_large_counts_stay_exact(n):
    total, kept = 10**14 + 3, 10**6
    got = divergence.probability(np.array([n, 1], "int64"), total, kept)
    assert got.tolist() == [1 + 10**9 * (x + 2) // (total + 2 * kept) for x in (n, 1)]


def test_dense_counts_of_a_text_without_kept_terms(spark):
    rows = [("en", "a", "one")] * 10 + [("en", "b", "two")] * 9
    assert rows_of(source_divergence(frame(spark, rows))) == plain(rows)


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(op13_perfect_hash_recount(spark, sf), duck(sf), OP13_SQL) is None


def test_mix_spreads(spark):
    h = hashes([str(i).encode() for i in range(4000)])
    places = divergence._mix(h, np.uint64(3)) % np.uint64(64)
    assert np.bincount(places.astype(int)).max() < 120
