"""The pipeline's stages, each on what its predecessor kept."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
from lodestar.llm.mixing import document_sizes, fair_mix
from lodestar.llm.neardup import near_duplicates
from test_rules_secrets_pii import BASE_PII, valid

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark, documents, tmp_path):
    out, docs = {}, documents
    for name, f in corpus_pipeline.STAGES:
        f(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = out[name] = spark.read.parquet(f"{tmp_path}/{name}")
    assert list(out) == ["quality_rules", "near_duplicates", "personal_data", "mix_sources", "best_fit_packing"]
    for name in list(out)[:-1]:
        assert out[name].columns == documents.columns
    texts = {n: {r["doc_id"]: r["text"] for r in d.select("doc_id", "text").collect()} for n, d in out.items() if n != "best_fit_packing"}
    whole = {r["doc_id"]: r["text"] for r in documents.collect()}

    # quality: good documents stay, what stays is untouched
    kept = texts["quality_rules"]
    assert all(kept[i] == whole[i] and len(WORD.findall(kept[i])) >= 10 for i in kept)
    good = [r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()]
    assert sum(i in kept for i in good) >= 0.97 * len(good)

    # near duplicates: one document of every class of the stage's input
    classes = near_duplicates(out["quality_rules"]).select("class").distinct().count()
    once = texts["near_duplicates"]
    assert len(once) == classes == out["near_duplicates"].count()
    assert set(once.values()) == set(map(kept.get, once)) and {t for t in kept.values()} >= set(once.values())
    assert len(set(once.values())) == len(once)

    # personal data: the same documents; no strict span is left, clean texts are untouched
    private = texts["personal_data"]
    assert set(private) == set(once)
    for i, t in private.items():
        had = any(valid(k, m) for k, p in BASE_PII.items() for m in p.finditer(once[i]))
        left = [m.group() for k, p in BASE_PII.items() for m in p.finditer(t) if valid(k, m)]
        assert not left, (i, left)
        if not re.search(r"[0-9@]", once[i]):
            assert t == once[i]
        if had:
            assert t != once[i]

    # mix: every document as often as the mix of the stage's input takes it
    mixed = out["mix_sources"].groupBy("doc_id").count().collect()
    taken = {r["row"]["doc_id"]: r["copies"] for r in fair_mix(document_sizes(out["personal_data"])).collect()}
    assert {r["doc_id"]: r["count"] for r in mixed} == {i: c for i, c in taken.items() if c}

    # packing: each mixed row's pieces are there, sequences are gapless
    rows = out["best_fit_packing"].collect()
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == Counter({i: c for i, c in taken.items() if c})
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def test_run_gives_the_last_stage(spark, make_docs, sf_of):
    rows = [(i, f"some words of text number {i} that go on for a while until the end of it {i * 7} times") for i in range(30)] + [(31, None), (32, "")]
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    out = corpus_pipeline.run(spark, sf_of(documents=make_docs(rows), labels=labels))
    assert set(out.columns) >= {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    assert {r["doc_id"] for r in out.collect()} <= set(range(30))
    assert corpus_pipeline.run(spark, sf_of(documents=make_docs([]), labels=labels.limit(0))).count() == 0
