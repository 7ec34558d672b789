"""Operator 3 against all pairs of shingle sets."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import neardup
from lodestar.llm.neardup import components, deduplicate, gamma_tables, op3_weighted_minhash, samples

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def classes_of(got):
    out = defaultdict(set)
    for r in got:
        out[r["class_id"]].add(r["doc_id"])
    return out


def pair_similarities(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    both = Counter()
    for v in holders.values():
        both.update((a, b) for k, a in enumerate(v) for b in v[k + 1 :])
    return {(a, b): n / (len(sets[a]) + len(sets[b]) - n) for (a, b), n in both.items()}


def check(texts, got):
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    cls = {r["doc_id"]: r["class_id"] for r in got}
    size = Counter(cls.values())
    assert all(r["class_size"] == size[r["class_id"]] for r in got)
    assert all(min(v) == k for k, v in classes_of(got).items())
    sims = pair_similarities(texts)
    by_text = defaultdict(list)
    for i, t in texts.items():
        by_text[t].append(i)
    assert all(len({cls[i] for i in v}) == 1 for v in by_text.values())
    lost = [(p, s) for p, s in sims.items() if s >= 0.8 and cls[p[0]] != cls[p[1]]]
    assert not lost, lost[:5]
    best = Counter()
    for (a, b), s in sims.items():
        best[a], best[b] = max(best[a], s), max(best[b], s)
    alone = [i for i in texts if size[cls[i]] > 1 and len(by_text[texts[i]]) == 1 and best[i] < 0.77]
    assert not alone, alone[:5]


def test_over_documents(spark, documents):
    check({r["doc_id"]: r["text"] for r in documents.collect()}, op3_weighted_minhash(spark, "/root/testdata/sf0.01").collect())


def test_hard_rows(spark, make_docs, sf_of):
    long = " ".join(f"w{i % 977}x{i % 1009}" for i in range(25_000))
    rows = [(1, None), (2, None), (3, ""), (4, ""), (5, " \n"), (6, "a b"), (7, "a  b"), (8, "a b c"), (9, long), (10, long + " tail"), (11, "x " * 500)]
    docs = make_docs(rows, extra=("n", "class", "text_key", "key"))
    got = {r["doc_id"]: r["class_id"] for r in op3_weighted_minhash(spark, sf_of(documents=docs)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6, 7: 6, 8: 8, 9: 9, 10: 9, 11: 11}
    kept = deduplicate(spark.read.parquet(sf_of(documents=docs) + "/documents.parquet"))
    assert kept.columns == docs.columns
    assert Counter(got[r["doc_id"]] for r in kept.collect()) == Counter(set(got.values()))


def test_repeated_rows_and_empty(spark, make_docs, sf_of):
    sf = sf_of(documents=make_docs([(1, "one two three four five six"), (1, "one two three four five six"), (None, "z")]))
    got = op3_weighted_minhash(spark, sf).collect()
    assert Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in got) == {(1, 1, 2): 2, (None, None, 1): 1}
    assert deduplicate(spark.read.parquet(f"{sf}/documents.parquet")).count() == 2
    assert op3_weighted_minhash(spark, sf_of(documents=make_docs([]))).count() == 0


def test_large_groups_and_shared_passage(spark, make_docs, sf_of, monkeypatch):
    """Buckets over the bound: many near copies, and texts that share half."""
    monkeypatch.setattr(neardup, "SMALL", 32)
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    base, passage, texts = [word() for _ in range(120)], [word() for _ in range(60)], {}
    for i in range(150):
        t = list(base)
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = word()
        texts[i] = " ".join(t)
    for i in range(150, 300):
        texts[i] = " ".join(passage + [word() for _ in range(60)])
    check(texts, op3_weighted_minhash(spark, sf_of(documents=make_docs(list(texts.items())))).collect())


def test_samples_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    tables = gamma_tables()
    same = []
    for trial in range(40):
        ids = np.unique(rng.integers(0, 2**32, 400, dtype="uint64").astype("uint32"))
        w = rng.uniform(0.9, 1.3, len(ids))
        keep = rng.random(len(ids)) < 0.75
        pair = np.concatenate([ids, ids[keep]])
        got = samples(pair, np.log(np.concatenate([w, w[keep]])).astype("float32"), np.array([0, len(ids)]), tables)
        same.append((got[0] == got[1]).mean() - w[keep].sum() / w.sum())
    assert abs(np.mean(same)) < 0.02


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 102), (101, 102)], "a long, b long")
    got = {r["n"]: r["c"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_near_pairs_inside_a_large_template_group(spark, make_docs, sf_of):
    """Many texts at similarity 0.76, and pairs at 0.82 among them whose bands
    mostly lie in the template."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklm", k=7))
    template, texts = [word() for _ in range(173)], {}
    for i in range(1500):
        texts[i] = template + [word() for _ in range(27)]
    for i in range(40):
        texts[1500 + i] = texts[i][:-19] + [word() for _ in range(19)]
    rows = [(i, " ".join(t)) for i, t in texts.items()]
    got = {r["doc_id"]: r["class_id"] for r in op3_weighted_minhash(spark, sf_of(documents=make_docs(rows))).collect()}
    assert got == {i: i - 1500 if i >= 1500 else i for i in texts}


def test_passages_repeated_many_times_are_linked(spark, make_docs, sf_of):
    """A passage once and five hundred times: nearly the same set of shingles."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=8))
    rows = []
    for i in range(40):
        passage = " ".join(word() for _ in range(130))
        rows += [(2 * i, passage), (2 * i + 1, " ".join([passage] * 500))]
    got = {r["doc_id"]: r["class_id"] for r in op3_weighted_minhash(spark, sf_of(documents=make_docs(rows))).collect()}
    assert got == {i: i - i % 2 for i in range(80)}


def test_pairs_of_the_prefix_join_are_not_thinned_by_samples(spark):
    """Sets in one bucket whose samples are made to disagree."""
    rng = np.random.default_rng(4)
    base = np.sort(rng.choice(2**31, 300, replace=False).astype("uint32"))
    near = np.sort(np.concatenate([base[:-20], rng.choice(2**31, 20).astype("uint32") | np.uint32(1 << 31)]))
    sets = spark.createDataFrame([(1, bytearray(base.tobytes())), (2, bytearray(near.tobytes()))], "n long, ids binary")
    side = spark.createDataFrame([(1, 300.0, 300, [1] * 64), (2, 10.0, 300, [2] * 64)], "n long, total double, size long, sig array<tinyint>")
    pairs = spark.createDataFrame([(1, 2)], "a long, b long")
    table = spark.sparkContext.broadcast(np.ones(neardup.DF_BUCKETS, "float32"))

    class Held:
        table = sets

    assert neardup._verified(pairs, side, Held, table, 10).count() == 0
    assert [tuple(r) for r in neardup._verified(pairs, side, Held, table, 10, sampled=False).collect()] == [(1, 2)]


def test_a_text_meets_one_leader_a_round(spark, make_docs, monkeypatch):
    """Pairs that are verified, in a group with very many shared buckets."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=7))
    base, rows = [word() for _ in range(150)], []
    for i in range(400):
        t = list(base)
        t[rng.randrange(150)] = word()
        rows.append((i, " ".join(t)))
    seen, verified = [], neardup._verified
    monkeypatch.setattr(neardup, "_verified", lambda pairs, *a, **k: seen.append(pairs.count()) or verified(pairs, *a, **k))
    got = neardup.near_duplicates(make_docs(rows)).select("class").distinct().count()
    assert got == 1 and seen[0] < 400 and sum(seen) < 1000, seen


def test_parity_bits_never_lose_a_similar_pair(spark):
    """Sets at all distances: what the bits rule out is not similar, and they rule out most of what is not."""
    rng = np.random.default_rng(8)
    table, rows, similar = np.full(neardup.DF_BUCKETS, 3, "float32"), [], []
    for i in range(400):
        n = int(rng.integers(1, 3000)) if i % 4 else int(rng.integers(20, 300))
        base = rng.choice(2**32, n, replace=False).astype("uint32")
        other = base.copy()
        k = int(rng.integers(0, max(1, n // 4) + 1))
        other[:k] = rng.choice(2**32, k).astype("uint32")
        a, b = np.sort(np.repeat(base, rng.integers(1, 4, n))), np.sort(np.repeat(other, rng.integers(1, 4, n)))
        similar.append(neardup.similarity(a, b, table, 50) >= neardup.THRESHOLD)
        row = [i]
        for x in (a, b):
            ids, tf = neardup.runs_of(x)
            row += [neardup.parity(ids).tolist(), float(neardup.weights(ids, tf, table, 50).sum()), len(ids)]
        rows.append(tuple(row))
    df = spark.createDataFrame(rows, "i int, xparity array<bigint>, xtotal double, xsize long, yparity array<bigint>, ytotal double, ysize long")
    kept = {r["i"] for r in df.where(neardup.may_be_similar(lambda c: F.col(f"x{c}"), lambda c: F.col(f"y{c}"))).select("i").collect()}
    assert {i for i, s in enumerate(similar) if s} <= kept
    small_apart = [i for i in range(0, 400, 4) if not similar[i]]
    assert len([i for i in small_apart if i in kept]) < 0.4 * len(small_apart)
