"""Operator 6 against the tokenizer library."""

import random

import pytest

import public_tokenizers
from lodestar.llm import transducer
from lodestar.llm.transducer import TextTransducer, count_tokens, op6_transducer_counts

HARD = [
    None,
    "",
    "   \n",
    "Don't you'll I'VE 's 'd''t re'm",
    "a<|endoftext|>b <|startoftext|><|endoftext|> <|ENDOFTEXT|> <|end",
    "ΑΣ ΣΑΣ Σ İstanbul ŒUVRE ſtraße K Å Å éá ﬁ Ⅷ ²½ ١٢٣ 漢字 かな゙ \U0001f600\U0001f468‍\U0001f469",
    "x\x1cy\x85z\xa0w v​u　t",
    "1234567890 v3.0 <a href='x'>!!!???///",
    "no" * 40_000,
    "word " * 30_000,
    "́ leading mark",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def want(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_hard_texts(library):
    t = TextTransducer()
    for text in HARD:
        assert t.count(text or "") == want(library, text), text[:80]


def test_random_texts_and_chunks(library):
    t = TextTransducer()
    rng = random.Random(9)
    alphabet = "aaeeiinnttsslch zü'’ßéñ.,!1\n\tΣœ<|>" + "the ing"
    for _ in range(300):
        text = "".join(rng.choices(alphabet, k=rng.randint(1, 200)))
        if rng.random() < 0.2:
            text += "<|endoftext|>" + text[:9]
        assert t.count(text) == want(library, text), text
        k = rng.randint(1, 12)
        chunks = [text[i : i + k] for i in range(0, len(text), k)]
        assert t.total(t.joined([t.chunk_map(c) for c in chunks])) == want(library, text)


def test_over_documents(spark, documents, library):
    got = {r["doc_id"]: r for r in op6_transducer_counts(spark, "/root/testdata/sf0.01").collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    for r in rows:
        n = want(library, r["text"])
        assert (got[r["doc_id"]]["n_bytes"], got[r["doc_id"]]["n_tokens"]) == (len(r["text"].encode()), n)
        assert got[r["doc_id"]]["over_limit"] == (n > 2048)


def test_hard_rows(spark, make_docs, library):
    rows = [*enumerate(HARD), (None, "null id"), (3, HARD[3])]
    docs = make_docs(rows, extra=("n", "doc", "chunk", "n_tokens", "maps"))
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in count_tokens(docs, chunk_chars=1000).collect())
    assert got == sorted((str(i), len((t or "").encode()), want(library, t)) for i, t in rows)
    assert count_tokens(make_docs([])).count() == 0


ALPHABETS = ["abcdXYZ0123+/=", "ab'st<|>endoftx1", "漢字、。かなA1b", "aé́1-_.", "a1<|endoftext|>2b"]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_chunks_without_white_space(library, alphabet):
    t = TextTransducer()
    rng = random.Random(alphabet)
    for _ in range(150):
        text = "".join(rng.choices(alphabet, k=rng.randint(1, 300)))
        if rng.random() < 0.4:
            at = rng.randrange(len(text))
            text = text[:at] + "<|startoftext|>" + text[at:]
        k = rng.randint(1, 60)
        maps = [t.chunk_map(text[i : i + k]) for i in range(0, len(text), k)]
        assert t.total(t.joined(maps)) == want(library, text), text


def test_long_texts_without_white_space_keep_short_ends(spark, make_docs, library, monkeypatch):
    """Megabytes of encoded bytes: what travels is a few characters a chunk."""
    rng = random.Random(4)
    text = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=1_200_000))
    heads, tails = zip(*[(len(h), len(x)) for h, _, x in (TextTransducer().chunk_map(text[i : i + 30_000]) for i in range(0, 300_000, 30_000))], strict=True)
    assert max(heads) < 200 and max(tails) < 200
    monkeypatch.setattr(transducer, "FAN", 3)
    word = "x" * 90_000
    docs = make_docs([(1, text), (2, word), (3, "short"), (4, None), (1, "again " * 20_000)])
    got = sorted((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in count_tokens(docs).collect())
    assert got == sorted((i, len((t or "").encode()), want(library, t)) for i, t in [(1, text), (2, word), (3, "short"), (4, None), (1, "again " * 20_000)])
