"""Source divergence audit by a recount over minimal perfect hashes.

First pass: in how many documents of its language each term occurs, exactly;
terms under ``min_docs`` are dropped.  The kept terms of a language are dealt
to shards by a hash, and each shard is compiled, in a task, to a minimal
perfect hash: one displacement per bucket sends its keys to places 0..n-1
without collision or gap, and the keys themselves are stored by place, so that
any other term is told from a kept one by a comparison.  Second pass: the
shards are broadcast and the texts are read again; every (language, source)
group counts in dense arrays, one slot a kept term.  What is broadcast at once
is at most ``SHIPPED`` bytes; more shards are counted in further passes over
the texts.  The dense arrays of a task hold at most ``SLOTS`` counts; beyond
that they are handed on and cleared.  They leave the task as packed rows, one a
group and shard, and are added in rounds of ``FAN`` at a time, so no term is a
row of its own and no task adds up what all others have counted.

A shard of a language is also the block in which its sources are compared, a
tile of ``TILE`` sources against all: their probabilities of the block's terms
are small matrices (``CELLS`` values), and only sums per pair of sources and the
best terms leave the task.

Arithmetic is exact: probabilities are billionths, floored, in 64-bit integers
or, where those could overflow, Python's; divergences are 64-bit integers.

Defined results: null text, language or source counts as an empty string; a
text without terms still makes its group; very long texts are read whole; ties
in value rank by the item's bytes; repeated rows count each; an empty table
gives an empty result; a language without kept terms has pairs of value 0 and
no terms; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.session import stage

MIN_DOCS = 10
TOP = 10
UNIT = 10**9
SHARD = 2048  # kept terms of a shard, about; fewer where there are many sources
CELLS = 1 << 21  # sources times terms of a block, about
FAN = 64  # packed rows added together in a round
SHIPPED = 16 << 20
SLOTS = 1 << 22
HELD = 500_000  # distinct (language, term) pairs a task holds before it hands them on
TILE = 256  # sources compared together

# A term is a run of ASCII letters and characters beyond ASCII.  In UTF-8 those
# are the bytes of letters and all bytes from 0x80 on; the others end a term.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in order, A-Z in lower case."""
    return text.translate(FOLD).split()


def _texts(docs: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(blank("lang").alias("lang"), blank("source").alias("source"), blank("text").cast("binary").alias("text"))


# -------------------------------------------------------------- first pass
def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, docs): terms in at least ``min_docs`` documents of the language."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict[str, Counter] = {}
        size = 0

        def flush():
            for lang, seen in held.items():
                cols = [pa.array([lang] * len(seen), pa.string()), pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["lang", "term", "docs"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seen = held.setdefault(lang, Counter())
                size -= len(seen)
                seen.update(set(terms(text.as_py())))
                size += len(seen)
                if size >= HELD:
                    yield from flush()
                    size = 0
        yield from flush()

    found = _texts(docs).select("lang", "text").mapInArrow(run, "lang string, term string, docs long")
    return found.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)


# --------------------------------------------------- minimal perfect hashes
def _mix(x, seed):
    """A 64-bit mix of hashes (uint64 array) with a seed (uint64 scalar or array)."""
    import numpy as np

    x = (x ^ seed) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def hashes(keys: list[bytes]):
    import numpy as np
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), "uint64", len(keys))


def build_hash(keys: list[bytes]):
    """(displacement per bucket, keys by place).  A positive displacement d
    sends a key to mix(hash, d) mod n; -1 - place names the only key's place."""
    import numpy as np

    n = len(keys)
    h = hashes(keys)
    bucket = (_mix(h, np.uint64(0)) % np.uint64(n)).astype("int64")
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    groups = sorted(np.split(order, cuts[1:]), key=len, reverse=True)
    displacement, place, free = np.zeros(n, "int64"), np.empty(n, "int64"), np.ones(n, bool)
    for k, group in enumerate(groups):
        if len(group) == 1:
            rest = np.flatnonzero(free)
            single = np.concatenate(groups[k:])
            place[single] = rest
            displacement[bucket[single]] = -1 - rest
            break
        d = 0
        while True:
            d += 1
            at = (_mix(h[group], np.uint64(d)) % np.uint64(n)).astype("int64")
            if free[at].all() and len(set(at.tolist())) == len(at):
                break
        displacement[bucket[group[0]]] = d
        place[group] = at
        free[at] = False
    by_place = [b""] * n
    for key, at in zip(keys, place.tolist(), strict=True):
        by_place[at] = key
    return displacement, by_place


class PerfectHash:
    """Places of the kept terms of one shard; -1 for any other term."""

    def __init__(self, displacement, by_place: list[bytes]):
        self._displacement, self._keys = displacement, by_place

    def __len__(self) -> int:
        return len(self._keys)

    def places(self, keys: list[bytes], h):
        import numpy as np

        n = np.uint64(len(self._keys))
        d = self._displacement[(_mix(h, np.uint64(0)) % n).astype("int64")]
        at = np.where(d < 0, -1 - d, (_mix(h, np.maximum(d, 0).astype("uint64")) % n).astype("int64"))
        stored = self._keys
        known = np.fromiter((stored[i] == k for i, k in zip(at.tolist(), keys, strict=True)), bool, len(keys))
        return np.where(known, at, -1)


def shard_terms(kept: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, shard, displacement, keys) per shard of the kept terms; ``langs``
    (lang, shards, ...).  Keys are joined by spaces, which no term holds."""

    def mark(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            h = hashes([t.as_py().encode() for t in batch.column(1)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((h >> 1).astype("int64"))], names=["lang", "term", "h"])

    def compile_shard(key, table):
        import pyarrow as pa

        displacement, by_place = build_hash([t.encode() for t in sorted(table.column("term").to_pylist())])
        return pa.table(
            {"lang": [key[0].as_py()], "shard": [key[1].as_py()], "displacement": [displacement.astype("<i8").tobytes()], "keys": [b" ".join(by_place)]}
        )

    marked = kept.select("lang", "term").mapInArrow(mark, "lang string, term string, h long")
    dealt = marked.join(langs.select("lang", "shards"), "lang").select("lang", F.pmod("h", "shards").alias("shard"), "term")
    return dealt.groupBy("lang", "shard").applyInArrow(compile_shard, "lang string, shard long, displacement binary, keys binary")


# ------------------------------------------------------------- second pass
PACKED = "lang string, source string, shard long, part long, slots binary, counts binary, total long"


def packed_row(lang: str, source: str, shard: int, part: int, counts) -> tuple:
    """Dense counts as their non-zero slots."""
    import numpy as np

    slots = np.flatnonzero(counts)
    return lang, source, shard, part, slots.astype("<i4").tobytes(), counts[slots].astype("<i8").tobytes(), int(counts.sum())


def unpacked(slots: bytes, counts: bytes):
    import numpy as np

    return np.frombuffer(slots, "<i4"), np.frombuffer(counts, "<i8")


def _table(rows: list[tuple], schema: str):
    import pyarrow as pa

    fields = [f.strip().split(" ") for f in schema.split(",")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.table({name: pa.array([r[i] for r in rows], kinds[kind]) for i, (name, kind) in enumerate(fields)})


def recount(docs: DataFrame, shards: DataFrame, langs: DataFrame, shipped: int | None = None) -> DataFrame:
    """(lang, source, shard, part, slots, counts, total): occurrences of every
    kept term in each group, one packed row per group and shard that has any."""
    spark = docs.sparkSession
    shipped = SHIPPED if shipped is None else shipped
    size = F.length("displacement") + F.length("keys")
    # numbers of shards and their bytes: one row for about SHARD terms
    sizes = shards.select("lang", "shard", size.alias("bytes")).orderBy("lang", "shard").toLocalIterator()
    loads, load, room = [], [], 0
    for r in sizes:
        if load and room + r["bytes"] > shipped:
            loads, load, room = [*loads, load], [], 0
        load, room = [*load, (r["lang"], r["shard"])], room + r["bytes"]
    out = spark.createDataFrame([], PACKED)
    for load in [*loads, load] if load else []:
        chosen = spark.createDataFrame(load, "lang string, shard long")
        rows = shards.join(F.broadcast(chosen), ["lang", "shard"]).join(langs.select("lang", "shards"), "lang")
        rows = rows.select("lang", "shards", "shard", "displacement", "keys").collect()  # at most ``shipped`` bytes, or one shard
        sent = spark.sparkContext.broadcast([(*r[:3], bytes(r["displacement"]), bytes(r["keys"])) for r in rows])
        out = out.union(_added(stage(_count(docs, sent), "divergence_counts")))
        sent.unpersist()
    return out


def _added(packed: DataFrame) -> DataFrame:
    """One row per group and shard: ``FAN`` neighbouring parts are added, and so
    on until one part is left."""

    def add(key, table):
        import numpy as np

        both = [unpacked(a, b) for a, b in zip(table.column("slots").to_pylist(), table.column("counts").to_pylist(), strict=True)]
        counts = np.zeros(max(int(a[-1]) for a, _ in both if len(a)) + 1 if any(len(a) for a, _ in both) else 0, "int64")
        for slots, n in both:
            counts[slots] += n
        return _table([packed_row(*(k.as_py() for k in key), counts)], PACKED)

    while True:
        last = packed.agg(F.max("part").alias("part")).first()["part"] or 0
        halved = packed.withColumn("part", F.floor(F.col("part") / FAN))
        packed = stage(halved.groupBy("lang", "source", "shard", "part").applyInArrow(add, PACKED), "divergence_added")
        if last < FAN:
            return packed


def _count(docs: DataFrame, sent) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        tables: dict = {}
        for lang, shards, shard, displacement, keys in sent.value:
            tables.setdefault(lang, (shards, {}))[1][shard] = PerfectHash(np.frombuffer(displacement, "<i8"), keys.split(b" "))
        dense: dict = {}  # (lang, source, shard) -> counts by slot
        held = 0

        def flush():
            rows = [packed_row(*group, part, counts) for group, counts in dense.items()]
            dense.clear()
            for a in range(0, len(rows), 1000):
                yield from _table(rows[a : a + 1000], PACKED).to_batches()

        for batch in batches:
            seen: dict = {}
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if lang in tables:
                    seen.setdefault((lang, source), Counter()).update(terms(text.as_py()))
            hashed: dict = {}  # the terms of a language in this batch
            for lang, _ in seen:
                if lang not in hashed:
                    keys = list(set().union(*(c for (other, _), c in seen.items() if other == lang)))
                    hashed[lang] = dict(zip(keys, zip(*_located(keys, *tables[lang]), strict=True), strict=True))
            for (lang, source), counted in seen.items():
                where = hashed[lang]
                at = np.array([where[k] for k in counted], "int64").reshape(-1, 2)
                n = np.fromiter(counted.values(), "int64", len(counted))
                known = at[:, 1] >= 0
                at, n = at[known], n[known]
                order = np.argsort(at[:, 0], kind="stable")
                at, n = at[order], n[order]
                cuts = np.flatnonzero(np.diff(at[:, 0], prepend=-1))
                for a, b in zip(cuts, np.append(cuts[1:], len(n)), strict=False):
                    shard = int(at[a, 0])
                    counts = dense.get((lang, source, shard))
                    if counts is None:
                        counts = dense[(lang, source, shard)] = np.zeros(len(tables[lang][1][shard]), "int64")
                        held += len(counts)
                    counts[at[a:b, 1]] += n[a:b]
                    if held > SLOTS:
                        yield from flush()
                        held = 0
        yield from flush()

    return _texts(docs).mapInArrow(run, PACKED)


def _located(keys: list[bytes], shards: int, tables: dict) -> tuple[list, list]:
    """Shard and place of each key; place -1: not a kept term of these tables."""
    import numpy as np

    h = hashes(keys)
    of = ((h >> np.uint64(1)) % np.uint64(shards)).astype("int64")
    place = np.full(len(keys), -1, "int64")
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.diff(of[order], prepend=-1))
    for at in np.split(order, cuts[1:]) if len(order) else ():
        table = tables.get(int(of[at[0]]))
        if table is not None:  # else counted in another pass
            place[at] = table.places([keys[i] for i in at], h[at])
    return of.tolist(), place.tolist()


# -------------------------------------------------------------- divergence
def probability(n, total: int, kept: int):
    """1 + floor(10**9 (n + 2) / (total + 2 kept)) of an array of counts, exactly."""
    import numpy as np

    if len(n) and int(n.max()) + 2 >= (1 << 63) // UNIT:
        return np.array([1 + UNIT * (int(x) + 2) // (total + 2 * kept) for x in n], "int64")
    return 1 + UNIT * (n + 2) // (total + 2 * kept)


FOUND = "lang string, source string, part string, item string, value long"


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) for ``docs`` (lang, source, text).

    Part ``pair``: for every source of a language each other source, by how
    far their term probabilities lie apart; part ``term``: the terms that the
    source has more often than its language, the ``top`` first."""
    kept = stage(kept_terms(docs, min_docs), "divergence_terms")
    groups = stage(_texts(docs).select("lang", "source").distinct(), "divergence_groups")
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    langs = langs.join(kept.groupBy("lang").agg(F.count("*").alias("kept")), "lang", "left").fillna(0, ["kept"])
    of_shard = F.greatest(F.least(F.lit(SHARD), F.floor(F.lit(CELLS) / F.col("sources"))), F.lit(1))
    shards = F.greatest(F.ceil(F.col("kept") / of_shard), F.lit(1)).cast("long")
    langs = stage(langs.withColumn("shards", shards).withColumn("tiles", F.ceil(F.col("sources") / TILE).cast("int")), "divergence_langs")
    compiled = stage(shard_terms(kept, langs), "divergence_shards")
    counts = stage(recount(docs, compiled, langs), "divergence_slots").drop("part")

    totals = counts.groupBy("lang", "source").agg(F.sum("total").alias("total"))
    totals = groups.join(totals, ["lang", "source"], "left").fillna(0, ["total"])
    lang_total = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    totals = totals.join(langs.join(lang_total, "lang"), "lang")
    every = totals.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    blocks = every.join(counts.drop("total"), ["lang", "source", "shard"], "left")
    tile = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile")
    blocks = blocks.select("lang", "shard", "source", "kept", "total", "lang_total", "tiles", "slots", "counts", tile)
    keys = compiled.join(langs.select("lang", "tiles"), "lang").select("*", tile)
    keys = keys.select(*[F.col(c).alias(f"key_{c}") for c in ("lang", "shard", "tile")], "keys")

    def compare(key, left, right):
        import zlib

        import numpy as np

        names = right.column("keys").to_pylist()
        names = names[0].split(b" ") if names else []
        sources, total, packed = left.column("source").to_pylist(), left.column("total").to_pylist(), left.select(["slots", "counts"]).to_pylist()
        lang, own_tile = key[0].as_py(), key[2].as_py()
        one = lambda c: left.column(c)[0].as_py()
        tiles, kept, lang_total = one("tiles"), one("kept"), one("lang_total")
        held = [unpacked(r["slots"] or b"", r["counts"] or b"") for r in packed]
        whole = np.zeros(len(names), "int64")
        for slots, n in held:
            whole[slots] += n
        lang_p = probability(whole, lang_total, kept) if names else whole

        def probabilities(some):
            """Those of the sources numbered ``some``, by slot."""
            out = np.zeros((len(some), len(names)), "int64")
            for i, k in enumerate(some):
                out[i, held[k][0]] = held[k][1]
                if names:
                    out[i] = probability(out[i], total[k], kept)
            return out

        def far(p, q):
            return (p - q) * (p - q) // (p + q)

        out: list[tuple] = []
        everyone = np.arange(len(sources))
        own = everyone[[zlib.crc32(s.encode()) % tiles == own_tile for s in sources]]
        mine = probabilities(own)
        for b in range(0, len(sources), TILE):
            others = everyone[b : b + TILE]
            theirs = probabilities(others)
            for i, p in zip(own, mine, strict=True):
                sums = far(p, theirs).sum(axis=1)
                out += [(lang, sources[i], "pair", sources[j], int(v)) for j, v in zip(others, sums, strict=True) if j != i]
        for i, p in zip(own, mine, strict=True):
            more = held[i][0]
            more = more[p[more] > lang_p[more]]
            f = far(p[more], lang_p[more])
            first = sorted(range(len(more)), key=lambda j: (-f[j], names[more[j]]))[:top]
            out += [(lang, sources[i], "term", names[more[j]].decode(), int(f[j])) for j in first]
        return _table(out, FOUND)

    parts = blocks.groupBy("lang", "shard", "tile").cogroup(keys.groupBy("key_lang", "key_shard", "key_tile"))
    found = stage(parts.applyInArrow(compare, FOUND), "divergence_parts")
    # an item of part term comes from one shard only
    found = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top)).select("lang", "source", "part", "item", "value", "rank")


def op13_perfect_hash_recount(spark, sf_dir: str) -> DataFrame:
    """How far the sources of each language lie apart, and by which terms."""
    return source_divergence(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "source", "text"))


OP13_SQL = r"""
with docs as (
  select row_number() over () as n, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents
), occurrences as (
  select n, lang, source,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{80}-\x{10FFFF}]+')) as term
  from docs
), per_doc as (
  select n, lang, source, term, count(*) as k from occurrences group by all
), kept as (
  select lang, term from per_doc group by all having count(*) >= 10
), groups as (
  select distinct lang, source from docs
), counts as (
  select g.lang, g.source, k.term, coalesce(c.k, 0) as k
  from groups g join kept k on g.lang = k.lang
  left join (select lang, source, term, sum(k) as k from per_doc group by all) c on c.lang = g.lang and c.source = g.source and c.term = k.term
), sizes as (
  select lang, count(*) as v from kept group by lang
), probs as (
  select lang, source, term, k, cast(1 + 1000000000 * (k::hugeint + 2) // (sum(k) over (partition by lang, source)::hugeint + 2 * v) as bigint) as p
  from counts join sizes using (lang)
), lang_counts as (
  select lang, term, sum(k)::hugeint as k from counts group by all
), lang_probs as (
  select lang, term, cast(1 + 1000000000 * (k + 2) // (sum(k) over (partition by lang)::hugeint + 2 * v) as bigint) as q
  from lang_counts join sizes using (lang)
), pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item,
         coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join probs x on x.lang = a.lang and x.source = a.source
  left join probs y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by all
), terms as (
  select x.lang, x.source, 'term' as part, x.term as item, ((x.p - q) * (x.p - q) // (x.p + q))::bigint as value
  from probs x join lang_probs using (lang, term) where x.k > 0 and x.p > q
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank
  from (select * from pairs union all select * from terms)
)
select lang, source, part, item, value, rank::int as rank from ranked where part = 'pair' or rank <= 10
"""
