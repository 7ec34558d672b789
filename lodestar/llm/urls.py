"""URL filters by Bloom filter cascades [native].

A url's keys are its host and, for each shape that the rules have (number of
host labels, length of the path), the end of its host with that many labels
followed by so much of its path.  The distinct keys of all pages are the
complete universe of questions, so a cascade can answer them exactly: level 1
is a Bloom filter of the listed keys, level 2 one of the other keys that level
1 lets through by mistake, level 3 one of the listed keys that level 2 lets
through, and so on until a level lets nothing through by mistake.  A key is
listed when the first level that does not hold it is an even one, or none is
missed and the last is odd.  Pages are judged in place: no join, no shuffle.

A level is an array of 64-bit words that a scalar subquery hands to every
task.  All levels together take about 1.44 log2(universe / listed) + 6 bits a
listed key that occurs; above ``FILTER_BITS`` the key space is cut by a hash
into shards with cascades of their own, and pages are judged shard by shard.
Rules of very many shapes are judged ``SHAPES`` shapes at a time.

Defined results: a null url, or one without ``://``, has an empty host and
path, no rule fits it and it is judged by its empty host; very long urls are
read whole; of the rules that fit the longest wins, at equal lengths the one
with the longer host, and of one rule listed with both verdicts ``block``;
repeated rows are judged each; an empty table gives an empty result; other
columns of ``pages`` are not read.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.session import stage

FILTER_BITS = 1 << 28
SHAPES = 16
HASHES = 16  # of one level at most
SHARD_SEED = -1

RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
# hosts with one of these words (between dots and hyphens) are listed
HOST_WORDS = ("ads", "adult", "bet", "bets", "casino", "pills", "poker", "porn", "spam", "xxx")


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


# ------------------------------------------------------------------ cascade
@dataclass
class Level:
    words: DataFrame  # one row: bits array<bigint>
    bits: int
    hashes: int
    seed: int

    def places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.seed + j)), F.lit(self.bits)) for j in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        words = self.words.scalar()
        bit = lambda at: F.getbit(F.element_at(words, (F.shiftright(at, 6) + 1).cast("int")), at.bitwiseAND(F.lit(63)).cast("int"))
        return reduce(and_, [bit(at) == 1 for at in self.places(key)])


def bloom_level(keys: DataFrame, n: int, false_share: float, seed: int) -> Level:
    """A Bloom filter of the column ``key``; its bits are or-ed in the map tasks."""
    hashes = min(max(round(-math.log2(false_share)), 1), HASHES)
    level = Level(keys, max(math.ceil(n * hashes / math.log(2)), 64), hashes, seed)
    at = keys.select(F.explode(F.array(*level.places(F.col("key")))).alias("at"))
    word = F.shiftright("at", 6).alias("word")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int")).alias("bits")
    empty = keys.sparkSession.range((level.bits + 63) // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = at.select(word, bit).groupBy("word").agg(F.bit_or("bits").alias("bits")).union(empty)
    words = words.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    # at most FILTER_BITS / 64 words in the one row
    level.words = stage(words.agg(F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"].alias("bits")), "urls_level")
    return level


def cascade(universe: DataFrame) -> list[Level]:
    """Levels that answer exactly, for every ``key`` of the universe, whether
    it is ``listed``."""
    side = stage(universe.select("key", F.col("listed").alias("inside")), "urls_keys")
    levels: list[Level] = []
    while True:
        n = {r["inside"]: r["n"] for r in side.groupBy("inside").agg(F.count("*").alias("n")).collect()}  # two rows
        inside, outside = n.get(True, 0), n.get(False, 0)
        if not inside:
            return levels
        share = 0.5 if levels else min(0.5, inside / (math.sqrt(2) * max(outside, 1)))
        level = bloom_level(side.where("inside"), inside, share, len(levels) * HASHES)
        levels.append(level)
        # what the level lets through by mistake is the inside of the next
        passed = side.where(F.col("inside") | level.holds(F.col("key")))
        side = stage(passed.select("key", (~F.col("inside")).alias("inside")), "urls_keys")


def listed(levels: Sequence[Level], key: Column) -> Column:
    """Whether the key is listed; exact for keys of the cascade's universe."""
    if not levels:
        return F.lit(False)
    answer = F.when(~levels[0].holds(key), F.lit(False))
    for i, level in enumerate(levels[1:], 1):
        answer = answer.when(~level.holds(key), F.lit(i % 2 == 1))
    return answer.otherwise(F.lit(len(levels) % 2 == 1))


def cascade_bits(n_listed: int, n_keys: int) -> int:
    """Bits of all levels, about."""
    return math.ceil(n_listed * (1.44 * math.log2(max(n_keys / max(n_listed, 1), 2)) + 6))


# -------------------------------------------------------------------- rules
def shaped(host: Column, path: Column, labels: int, length: int) -> Column:
    """The url's key of a shape; null when it is too short for it."""
    enough = (F.length(host) - F.length(F.replace(host, F.lit("."))) >= labels - 1) & (F.length(path) >= length)
    return F.when(enough, F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, length)))


def filter_urls(pages: DataFrame, rules: DataFrame, hosts: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of ``pages`` (page_id, url).

    ``rules`` (rule, verdict): host and path of a rule as one string with a
    slash between, like ``example.org/es/``; it fits the host, all its
    subdomains and every path that starts with its path.  ``hosts`` (host):
    hosts to block where no rule fits.  Neither has a bound on its size."""
    host, path = host_and_path("url")
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    slash = F.instr("rule", "/")
    given = rules.select("rule", "verdict", F.substring_index("rule", "/", 1).alias("h"), F.substring(F.col("rule"), slash, F.length("rule")).alias("p"))
    given = given.where((slash > 0) & F.col("verdict").isin("allow", "block"))
    shapes = given.select((F.length("h") - F.length(F.replace("h", F.lit("."))) + 1).alias("labels"), F.length("p").alias("length")).distinct()
    shapes = sorted(tuple(r) for r in shapes.collect())  # pairs of small numbers
    keys = [shaped(F.col("host"), F.col("path"), *s) for s in shapes]
    key_list = given.select(F.col("rule").alias("key"), "verdict")
    if hosts is not None:
        key_list = key_list.union(hosts.select(F.col("host").alias("key"), F.lit("block").alias("verdict")))
    key_list = key_list.groupBy("key").agg(F.max("verdict").alias("verdict"))
    # hosts hold no slash and rules do, so the two kinds of keys never meet
    asked = urls.select(F.explode(F.array(F.col("host"), *keys)).alias("key")).where("key is not null").distinct()
    universe = stage(asked.join(key_list, "key", "left"), "urls_universe")
    n = universe.agg(F.count("*").alias("all"), F.count("verdict").alias("listed")).first()
    shards = max(1, math.ceil(cascade_bits(n["listed"], n["all"]) / FILTER_BITS))
    shard = lambda key: F.pmod(F.xxhash64(key, F.lit(SHARD_SEED)), F.lit(shards))

    best = "struct<length:int,host:int,rule:string,verdict:string>"
    judged = urls.withColumn("best", F.lit(None).cast(best)).withColumn("by_host", F.lit(False))
    passes = shards * max(1, math.ceil(len(shapes) / SHAPES))
    for s in range(shards):
        mine = universe.where(shard(F.col("key")) == s)
        found = {v: cascade(mine.select("key", F.coalesce(F.col("verdict") == v, F.lit(False)).alias("listed"))) for v in ("allow", "block")}

        def told(key: Column, width: Column, s=s, found=found) -> Column:
            fits = F.lit(True) if shards == 1 else shard(key) == s
            row = lambda v: F.struct(F.length(key).alias("length"), F.length(width).alias("host"), key.alias("rule"), F.lit(v).alias("verdict"))
            return F.when(key.isNull() | ~fits, F.lit(None)).when(listed(found["block"], key), row("block")).when(listed(found["allow"], key), row("allow"))

        own = listed(found["block"], F.col("host"))
        own = own if shards == 1 else (shard(F.col("host")) == s) & own
        judged = judged.withColumn("by_host", F.col("by_host") | own)
        for a in range(0, len(shapes), SHAPES):
            tried = [told(k, F.substring_index(k, "/", 1)) for k in keys[a : a + SHAPES]]
            judged = judged.withColumn("best", F.greatest("best", *[t.cast(best) for t in tried]))
            if passes > 1:
                judged = stage(judged, "urls_judged")
    otherwise = F.when(F.col("by_host"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", otherwise).alias("verdict"))


def hosts_with_words(pages: DataFrame, words: Sequence[str] = HOST_WORDS) -> DataFrame:
    """The distinct hosts of the pages that have one of the words between dots and hyphens."""
    host, _ = host_and_path("url")
    return pages.select(host.alias("host")).distinct().where(F.arrays_overlap(F.split("host", "[.-]"), F.array(*[F.lit(w) for w in words])))


def op12_bloom_cascade(spark, sf_dir: str) -> DataFrame:
    """The rule that fits each page's url and the verdict: the rule's, else
    whether the cascade holds its host."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict")) for r, v in RULES]))
    return filter_urls(pages, spark.range(1).select(rules), hosts_with_words(pages))


_WORDS = ", ".join(f"'{w}'" for w in HOST_WORDS)
OP12_SQL = f"""
with parts as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), split_up as (
  select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw_host from parts
), urls as (
  select page_id,
         translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') as path
  from split_up
), rules(rule, rule_host, rule_path, verdict) as (
  values {", ".join(f"('{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{v}')" for r, v in RULES)}
), fits as (
  select u.page_id, u.host, u.path, r.rule, r.verdict,
         row_number() over (partition by u.page_id order by length(r.rule) desc nulls last) as nth
  from urls u left join rules r
    on (u.host = r.rule_host or ends_with(u.host, '.' || r.rule_host)) and starts_with(u.path, r.rule_path)
)
select page_id, host, path, rule,
       coalesce(verdict, case when len(list_intersect(regexp_split_to_array(host, '[.-]'), [{_WORDS}])) > 0
                              then 'block' else 'allow' end) as verdict
from fits where nth = 1
"""
