"""URL filters against direct matching and a brute-force membership test."""

import math

import pytest
from oracle import compare, duck
from pyspark.sql import functions as F

from lodestar.llm import urls
from lodestar.llm.urls import HOST_WORDS, OP12_SQL, RULES, cascade, filter_urls, listed, op12_bloom_cascade


def plain(url, rules, hosts):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host) :]
    for c in "?#":
        path = path.split(c)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule, verdict in rules:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), len(h), rule, verdict))
    if fits:
        return host, path, max(fits)[2], max(fits)[3]
    return host, path, None, "block" if hosts(host) else "allow"


ODD = [
    None, "", "example.org/es/1", "http://", "http://example.org", "HTTP://EXAMPLE.ORG/es/", "http://Example.Org/ES/", "x://org/", "x://a.b.org/en/12",
    "http://example.org/en/1", "http://notexample.org/es/1", "http://a.example.org/es/1?x=/y", "http://org?x", "http://com/fr/1#a", "http://xcom/fr/1",
    "http://.org/", "http://a..com/de/", "http://com/de", "http://my-casino.net/", "http://casinos.net/", "http://a.b.c.d.e.f.com/de/x", "a://b://c.org/",
    "http://ex\nample.org/e\ns/", "http://xxx/", "http://user@bets.example.net:80/p", "http://x.com/" + "p" * 100_000, "http://" + "a." * 3000 + "org/x", "http://ÀB.org/é",
]


def got_rows(df):
    return sorted((tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)


def words_in(host):
    return any(w in HOST_WORDS for w in host.replace("-", ".").split("."))


def test_odd_urls(spark, sf_of):
    rows = [(i, u, "x", "y") for i, u in enumerate(ODD)] + [(3, "http://a.com/de/", "x", "y")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    got = got_rows(op12_bloom_cascade(spark, sf_of(pages=pages)))
    assert got == sorted(((i, *plain(u, RULES, words_in)) for i, u, *_ in rows), key=repr)


def test_empty_table(spark, sf_of):
    assert got_rows(op12_bloom_cascade(spark, sf_of(pages=spark.createDataFrame([], "page_id long, url string")))) == []


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(op12_bloom_cascade(spark, sf), duck(sf), OP12_SQL) is None


@pytest.mark.parametrize("share", [0.01, 0.5, 1.0])
def test_cascade_is_exact(spark, share):
    n = 3000
    keys = spark.range(n).select(F.concat(F.lit("k"), "id").alias("key"), (F.pmod(F.xxhash64("id"), F.lit(n)) < n * share).alias("listed"))
    levels = cascade(keys)
    assert len(levels) > 1 or share == 1.0
    wrong = keys.where(listed(levels, F.col("key")) != F.col("listed"))
    assert wrong.count() == 0
    bits = sum(level.bits for level in levels)
    n_listed = keys.where("listed").count()
    assert bits <= 64 * len(levels) + 1.3 * urls.cascade_bits(n_listed, n) + n * 1.5 * (share > 0.4)


def test_nothing_listed(spark):
    keys = spark.range(5).select(F.col("id").cast("string").alias("key"), F.lit(False).alias("listed"))
    assert cascade(keys) == []
    assert keys.where(listed([], F.col("key"))).count() == 0


def test_shards_and_shape_groups_change_nothing(spark, monkeypatch):
    rules = [(f"h{i % 7}.net/{'p' * (i % 5)}", "block" if i % 3 else "allow") for i in range(60)]
    rules = list(dict(rules).items())
    hosts = [f"b{i}.org" for i in range(0, 60, 2)]
    seen = [f"http://x.h{i % 9}.net/{'p' * (i % 6)}" for i in range(200)] + [f"http://b{i}.org/q" for i in range(60)]
    pages = spark.createDataFrame(list(enumerate(seen)), "page_id long, url string")
    monkeypatch.setattr(urls, "FILTER_BITS", 200)
    monkeypatch.setattr(urls, "SHAPES", 2)
    got = got_rows(filter_urls(pages, spark.createDataFrame(rules, "rule string, verdict string"), spark.createDataFrame([(h,) for h in hosts], "host string")))
    assert got == sorted(((i, *plain(u, rules, lambda h: h in hosts)) for i, u in enumerate(seen)), key=repr)


def test_rule_listed_twice_and_without_hosts(spark):
    pages = spark.createDataFrame([(1, "http://a.de/x"), (2, "http://b.de/")], "page_id long, url string")
    rules = spark.createDataFrame([("a.de/", "allow"), ("a.de/", "block"), ("de/", "allow"), ("bad", "block"), (None, "block"), ("b.de/", None)], "rule string, verdict string")
    assert got_rows(filter_urls(pages, rules)) == [(1, "a.de", "/x", "a.de/", "block"), (2, "b.de", "/", "de/", "allow")]


def test_bits_grow_with_the_list():
    assert cascade_bits_per_key(1000, 10**9) < 40 and math.isclose(urls.cascade_bits(0, 10), 0)


def cascade_bits_per_key(n, total):
    return urls.cascade_bits(n, total) / n
