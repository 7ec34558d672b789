"""Near-duplicate detection by improved consistent weighted sampling.

A text is a weighted set of five-word shingles: weight = damped term count
times damped inverse document frequency.  Consistent weighted samples make two
texts agree in a sample with probability equal to their weighted Jaccard
similarity; ``ROWS`` samples form a band, texts that share a band are
candidates, and candidates are verified by their exact weighted Jaccard
similarity (``THRESHOLD``; a pair whose plain Jaccard similarity reaches it
is linked too, so the weights lose no pair at the border).  Links join texts
into classes.

Weights.  A near copy differs from its group in shingles of its own, which are
rare, and shares shingles that are as frequent as the group is large.  A full
IDF would make large groups fall apart, so term count and IDF enter damped:
(1 + DAMP (1 - 1 / tf)) (1 - DAMP ln df / ln N).  Both factors are bounded, so
the weights never hide a pair whose plain similarity is high.  Document frequencies cover all
documents; they are counted per hash bucket (``DF_BUCKETS``, a table of fixed
size), because a table of all shingles would be as large as the corpus.

No group is enumerated in full.  The first link is sought in rounds, in each of
which a text meets one other: the leader of the largest of its buckets that is
led by another class.  A bucket's leader is at first its most central text
(the one whose buckets are largest, for a group of near copies the one with the
fewest edits), later one by hash outside that text's class; links are
contracted to classes before the next round.  Buckets that then still hold
several classes and at most ``SMALL`` texts compare the texts of different
classes.  Larger ones are finished by an exact join on the rarest shingles
(``prefix_pairs``), so no pair of a bucket is left out.  Both joins carry parity
bits: two sets differ in at least as many shingles as their parities differ in
bits, so a pair that differs in too many bits cannot be similar and never
becomes a row.  Equal texts are one member from the start.

Rows are numbered once, in a written copy of the table; every pass reads that,
so the numbers hold whatever executors run it and however files are dealt to
tasks.

Defined results: null and blank texts form classes by equal text only (null
counts as a text of its own); a text under five words is one shingle; very
long texts are read whole; of equally central leaders the later row leads, of
a class the first row stays; repeated rows are documents of the same class; an
empty table gives an empty result; other columns are kept and never clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import words
from lodestar.session import stage

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 4
DAMP = 0.1
DF_BUCKETS = 1 << 18
AGREE = 0.5  # share of equal samples below which a pair is not verified
SMALL = 64
STARS = 3  # rounds of one meeting a text
PARITY = 16  # words of 64 parity bits
SPREAD = 1024  # rows of one shingle on the probing side of a join partition
MARKS = 1 << 21
CHUNK = 1 << 17  # shingles handled together


def shingle_ids(h):
    """Sorted 32-bit shingle ids (with repeats) of the 64-bit word hashes."""
    import numpy as np

    h = h.view("uint64")
    n = len(h)
    if n == 0:
        return np.zeros(0, "uint32")
    width = min(SHINGLE, n)
    x = np.full(n - width + 1, np.uint64(width))
    for j in range(width):
        x = (x ^ h[j : n - width + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    out = (x >> np.uint64(32)).astype("uint32")
    out.sort()
    return out


def runs_of(ids):
    """Distinct ids and how often each occurs, from sorted ids."""
    import numpy as np

    first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))) if len(ids) else np.zeros(0, "int64")
    return ids[first], np.diff(np.append(first, len(ids)))


def weights(ids, tf, df, n_docs: int):
    import numpy as np

    seen = np.clip(df[ids & np.uint32(DF_BUCKETS - 1)], 1, max(n_docs, 1))
    return (1 + DAMP * (1 - 1 / tf)) * (1 - DAMP * np.log(seen) / np.log(max(n_docs, 2)).clip(min=0.7))


def parity(ids):
    """For each of 64 * PARITY cells of the id space whether it holds an odd
    number of the distinct ids, as 64-bit words."""
    import numpy as np

    cell = (ids.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (64 * PARITY - 1).bit_length())
    odd = np.bincount(cell.astype("int64"), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype("uint8")).view("int64")


def may_be_similar(x, y):
    """Whether two texts, given as columns by name, can reach ``THRESHOLD``:
    sets of sizes a, b with similarity t differ in (1 - t) / (1 + t) (a + b)
    members at most, and a member weighs at least 1 - DAMP."""
    differ = sum((F.bit_count(x("parity")[i].bitwiseXOR(y("parity")[i])) for i in range(PARITY)), F.lit(0))
    share = (1 - THRESHOLD) / (1 + THRESHOLD)
    weighed = (x("total") + y("total")) * (share / (1 - DAMP))
    return differ <= F.greatest((x("size") + y("size")) * share, weighed) + 1e-3


def gamma_tables():
    """Quantiles of Gamma(2, 1) and their logarithms at 65,536 levels."""
    import numpy as np

    p = (np.arange(65536) + 0.5) / 65536
    lo, hi = np.zeros(65536), np.full(65536, 40.0)
    for _ in range(60):
        mid = (lo + hi) / 2
        below = 1 - (1 + mid) * np.exp(-mid) < p
        lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
    return lo.astype("float32"), np.log(lo).astype("float32")


def samples(ids, log_w, starts, tables):
    """Consistent weighted samples: a (sets x BANDS*ROWS) array of 64-bit
    sample hashes.  ``starts``: where each set begins in ``ids``."""
    import numpy as np

    r_of, log_c_of = tables
    lengths = np.diff(np.append(starts, len(ids)))
    owner = np.repeat(np.arange(len(starts)), lengths)
    out = np.zeros((len(starts), BANDS * ROWS), "uint64")
    mask = np.uint64(0xFFFF)
    base = ids.astype("uint64") * np.uint64(0xD6E8FEB86659FD93)
    for k in range(BANDS * ROWS):
        x = base ^ np.uint64((0xA0761D6478BD642F * (2 * k + 1)) & (2**64 - 1))
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xE7037ED1A0B428DB)
        x ^= x >> np.uint64(29)
        r = r_of[x & mask]
        beta = ((x >> np.uint64(32)) & mask).astype("float32") / np.float32(65536)
        t = np.floor(log_w / r + beta)
        log_a = log_c_of[(x >> np.uint64(16)) & mask] - r * (t - beta) - r
        least = np.minimum.reduceat(log_a, starts)
        hit = np.flatnonzero(log_a == least[owner])[::-1]
        out[owner[hit], k] = base[hit] ^ (t[hit].astype("int64").astype("uint64") * np.uint64(0x9FB21C651E98DF25))
    return out


def _hashed_words(docs: DataFrame) -> DataFrame:
    return docs.select("n", "text", F.transform(words("text"), lambda w: F.xxhash64(w)).alias("h"))


def document_frequencies(docs: DataFrame):
    """(table of DF_BUCKETS counts, number of documents with words): how many
    documents hold a shingle of each hash bucket."""
    import numpy as np

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        seen, docs_seen = np.zeros(DF_BUCKETS, "int64"), 0
        for batch in batches:
            col = batch.column(0)
            values, at = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()
            for a, b in zip(at[:-1], at[1:], strict=True):
                if b > a:
                    docs_seen += 1
                    ids, _ = runs_of(shingle_ids(values[a:b]))
                    np.add.at(seen, ids & np.uint32(DF_BUCKETS - 1), 1)
        full = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(full, -1), pa.int32()), pa.array(np.append(seen[full], docs_seen))], names=["bucket", "n"]
        )

    per = _hashed_words(docs).select("h").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = np.zeros(DF_BUCKETS, "float32")
    got = per.toArrow()  # at most DF_BUCKETS + 1 rows
    bucket, n = got.column("bucket").to_numpy(), got.column("n").to_numpy()
    table[bucket[bucket >= 0]] = n[bucket >= 0]
    return table, int(n[bucket < 0].sum())


def sketches(docs: DataFrame, df, n_docs: int) -> DataFrame:
    """(n, text_key, total, size, sig, bands, parity) per document: the sum of
    its weights, its distinct shingles, samples, bands and parity bits; texts
    without words have no bands."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        tables, table = gamma_tables(), df.value

        def flush(sets):
            ids = np.concatenate([s[0] for s in sets])
            w = np.concatenate([s[1] for s in sets])
            starts = np.cumsum([0] + [len(s[0]) for s in sets[:-1]])
            got = samples(ids, np.log(w).astype("float32"), starts, tables)
            keys = np.full((len(sets), BANDS), np.uint64(7))
            for j in range(ROWS):
                keys = (keys ^ got[:, j::ROWS]) * np.uint64(0x9E3779B97F4A7C15)
                keys ^= keys >> np.uint64(31)
            keys += np.arange(BANDS, dtype="uint64")  # bands never meet each other
            sig = ((got * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(56)).astype("uint8").view("int8")
            return keys.view("int64"), sig, np.add.reduceat(w, starts)

        for batch in batches:
            col = batch.column(2)
            values, at = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()
            bands, sigs, odd = ([None] * len(batch) for _ in range(3))
            totals, sizes = [0.0] * len(batch), [0] * len(batch)
            waiting, rows, size = [], [], 0
            for i in range(len(batch) + 1):
                if waiting and (i == len(batch) or size >= CHUNK):
                    keys, sig, total = flush(waiting)
                    for k, row in enumerate(rows):
                        bands[row], sigs[row], totals[row], sizes[row] = keys[k], sig[k], float(total[k]), len(waiting[k][0])
                    waiting, rows, size = [], [], 0
                if i < len(batch) and at[i + 1] > at[i]:
                    ids, tf = runs_of(shingle_ids(values[at[i] : at[i + 1]]))
                    odd[i] = parity(ids)
                    waiting.append((ids, weights(ids, tf, table, n_docs)))
                    rows.append(i)
                    size += len(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(totals), pa.array(sizes, pa.int64()), pa.array(sigs, pa.list_(pa.int8())),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(odd, pa.list_(pa.int64()))],
                names=["n", "text_key", "total", "size", "sig", "bands", "parity"],
            )

    h = _hashed_words(docs).select("n", F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("null")).alias("text_key"), "h")
    return h.mapInArrow(run, "n long, text_key string, total double, size long, sig array<tinyint>, bands array<bigint>, parity array<bigint>")


def similarity(a, b, df, n_docs: int) -> float:
    """Jaccard similarity of two sorted id arrays: the weighted one, or the
    plain one where that is higher."""
    import numpy as np

    (x, tx), (y, ty) = runs_of(a), runs_of(b)
    wx, wy = weights(x, tx, df, n_docs), weights(y, ty, df, n_docs)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = np.minimum(wx[i], wy[j]).sum()
    plain = len(i) / (len(x) + len(y) - len(i))
    return max(float(both / (wx.sum() + wy.sum() - both)), plain)


class _Sets:
    """The shingle sets of candidate texts, written once, bucketed by row."""

    def __init__(self, docs: DataFrame, candidates: DataFrame):
        spark = docs.sparkSession

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                col = batch.column(1)
                values, at = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()
                ids = [shingle_ids(values[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["n", "ids"])

        # texts stay where they are read: a table of hash marks of the
        # candidates, at most MARKS rows, filters the scan; a text that shares
        # a mark by chance is written too and never joined
        mark = F.pmod(F.xxhash64("n"), F.lit(MARKS)).alias("mark")
        marks = stage(candidates.select(mark).distinct(), "neardup_marks")
        need = docs.select("n", "text", mark).join(F.broadcast(marks), "mark", "left_semi")
        self.spark, self.name = spark, f"neardup_sets_{uuid.uuid4().hex}"
        sets = _hashed_words(need).select("n", "h").mapInArrow(run, "n long, ids binary")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        sets.repartition(parts, "n").write.bucketBy(parts, "n").saveAsTable(self.name)
        self.table = spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def prefix_pairs(sets: DataFrame, rest: DataFrame, df, n_docs: int) -> DataFrame:
    """Pairs (a, b) of texts of ``rest`` (n, c) in different classes c: all
    whose weighted or plain Jaccard similarity reaches ``THRESHOLD``, and some
    more.

    Shingles in one order, rare ones first.  Similar texts x, y have an overlap
    of at least t / (1 + t) of their sizes' sum, so the larger one has a common
    shingle where at least t of its size is still to come and the smaller one
    where 2 t / (1 + t) is; at the first common shingle both have as much to
    come as the overlap needs.  What a large group shares is frequent, comes
    last and mostly lies behind these prefixes."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        table, least, first = df.value, THRESHOLD - 1e-6, 2 * THRESHOLD / (1 + THRESHOLD) - 1e-6
        kinds = {"n": "int64", "c": "int64", "token": "int32", "total": "float64", "size": "int32", "to_come": "float64", "many": "int32", "head": "bool"}
        waiting, held = [], 0

        def flush():
            cols = [pa.array(np.concatenate([w[i] for w in waiting]).astype(t)) for i, t in enumerate(kinds.values())]
            odd = np.concatenate([np.tile(w[-1], len(w[0])) for w in waiting])
            odd = pa.ListArray.from_arrays(pa.array(np.arange(0, len(odd) + 1, PARITY), pa.int32()), pa.array(odd))
            return pa.RecordBatch.from_arrays([*cols, odd], names=[*kinds, "parity"])

        for batch in batches:
            for n, c, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ids, tf = runs_of(np.frombuffer(raw, "uint32"))
                w = weights(ids, tf, table, n_docs)
                order = np.lexsort((ids, table[ids & np.uint32(DF_BUCKETS - 1)]))
                to_come = np.cumsum(w[order][::-1])[::-1]
                total, size = to_come[0], len(ids)
                many = np.arange(size, 0, -1)
                probe = int(((to_come >= least * total) | (many >= least * size)).sum())
                head = (to_come >= first * total) | (many >= first * size)
                full = lambda x: np.full(probe, x)
                waiting.append((full(n), full(c), ids[order][:probe].view("int32"), full(total), full(size), to_come[:probe], many[:probe], head[:probe], parity(ids)))
                held += probe
                if held >= CHUNK:
                    yield flush()
                    waiting, held = [], 0
        if waiting:
            yield flush()

    kinds = "n long, c long, token int, total double, size int, to_come double, many int, head boolean, parity array<bigint>"
    found = stage(rest.join(sets, "n").select("n", "c", "ids").mapInArrow(run, kinds), "neardup_prefixes")
    tokens = found.groupBy("token").agg(F.count("*").alias("held"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo != hi")
    tokens = tokens.select("token", F.ceil(F.col("held") / SPREAD).alias("parts"))
    held = stage(found.join(tokens, "token"), "neardup_tokens")
    x = held.where("head").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).alias("x")
    y = held.withColumn("part", F.pmod(F.xxhash64("n"), F.col("parts"))).alias("y")

    def fits(size: str, left: str):
        a, b, near = F.col(f"x.{size}"), F.col(f"y.{size}"), F.least(f"x.{left}", f"y.{left}")
        return (a <= b * (1 + 1e-9)) & (a >= b * (THRESHOLD - 1e-6)) & (near >= (a + b) * (THRESHOLD / (1 + THRESHOLD) - 1e-6))

    on = (F.col("x.token") == F.col("y.token")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.c") != F.col("y.c"))
    close = may_be_similar(lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}"))
    pairs = x.join(y, on & (fits("total", "to_come") | fits("size", "many")) & close)
    return pairs.select(F.col("x.n").alias("a"), F.col("y.n").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """(n, c): every text that has a link, with the least row of its class.

    Labels spread along links and jump to the label of their label, so chains
    shorten fast; each round is staged, and sums over a text with very many
    links are combined in the map tasks."""
    both = stage(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "neardup_edges")
    labels = stage(both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.col("n")).alias("c")), "neardup_labels")
    while True:
        near = both.join(labels.select(F.col("n").alias("b"), "c"), "b").groupBy(F.col("a").alias("n")).agg(F.min("c").alias("m"))
        heard = labels.join(near, "n", "left").select("n", F.col("c").alias("old"), F.least("c", "m").alias("c"))
        root = labels.select(F.col("n").alias("c"), F.col("c").alias("r"))
        heard = heard.join(root, "c", "left").select("n", "old", F.least("c", "r").alias("c"))
        labels = stage(heard, "neardup_labels")
        if labels.where("old != c").isEmpty():
            return labels.select("n", "c")


def numbered(docs: DataFrame) -> DataFrame:
    """(n, doc): the rows of ``docs`` as structs, each with its number, written
    once."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return stage(docs.select(F.monotonically_increasing_id().alias("n"), doc), "neardup_docs")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(n, class): a number for each row of ``docs`` and the least number of
    its class."""
    return classes(numbered(docs).select("n", "doc.text"))


def classes(d: DataFrame) -> DataFrame:
    """(n, class) for a written table (n, text) whose numbers are unique."""
    spark = d.sparkSession
    table, n_docs = document_frequencies(d)
    df = spark.sparkContext.broadcast(table)  # DF_BUCKETS floats
    rows = stage(sketches(d, df, n_docs), "neardup_rows")
    firsts = stage(rows.groupBy("text_key").agg(F.min("n").alias("first")), "neardup_firsts")
    texts = rows.join(firsts.select(F.col("first").alias("n")), "n", "left_semi")
    sketch = stage(texts.where("bands is not null").select("n", "total", "size", "sig", "bands", "parity"), "neardup_texts")
    keys = sketch.select("n", F.explode("bands").alias("key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("held")).where("held > 1")
    keys = stage(keys.join(sizes, "key").select("key", "n", "held"), "neardup_shared")
    # a text in large buckets is central in its group: most links go there
    support = keys.groupBy("n").agg(F.sum("held").alias("support"))
    keys = stage(keys.join(support, "n"), "neardup_keys")
    sets = _Sets(d, keys.select("n").distinct())
    try:
        labels = _linked(sketch.drop("bands"), keys, sets, df, n_docs)
    finally:
        sets.drop()
    whole = rows.select("n", "text_key").join(firsts, "text_key")
    return whole.join(labels.select(F.col("n").alias("first"), "c"), "first", "left").select("n", F.coalesce("c", "first").alias("class"))


def _verified(pairs: DataFrame, side: DataFrame, sets: _Sets, df, n_docs: int, sampled: bool = True) -> DataFrame:
    """The pairs (a, b) whose Jaccard similarity, weighted or plain, is high
    enough.  Those that were found by bands are first thinned by the share of
    equal samples."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    if sampled:
        of = lambda c: side.select(F.col("n").alias(c), *[F.col(k).alias(f"{k}_{c}") for k in ("total", "size", "sig")])
        p = pairs.join(of("a"), "a").join(of("b"), "b")
        equal = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
        # neither measure exceeds the smaller set's share of the larger one
        near = lambda k: F.least(f"{k}_a", f"{k}_b") >= F.greatest(f"{k}_a", f"{k}_b") * (THRESHOLD - 1e-6)
        pairs = p.where((near("total") | near("size")) & (equal >= AGREE * BANDS * ROWS)).select("a", "b")
    p = stage(pairs, "neardup_pairs")
    heads = sets.table.join(p.select(F.col("a").alias("n")).distinct(), "n", "left_semi")
    p = p.join(sets.table.select(F.col("n").alias("b"), F.col("ids").alias("ids_b")), "b")
    p = p.join(heads.select(F.col("n").alias("a"), F.col("ids").alias("ids_a")), "a")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        table = df.value
        for batch in batches:
            a, b = (batch.column(i).to_pylist() for i in (2, 3))
            ok = [
                similarity(np.frombuffer(x, "uint32"), np.frombuffer(y, "uint32"), table, n_docs) >= THRESHOLD
                for x, y in zip(a, b, strict=True)
            ]
            keep = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], names=["a", "b"])

    return stage(p.select("a", "b", "ids_a", "ids_b").mapInArrow(run, "a long, b long"), "neardup_links")


def _linked(side: DataFrame, keys: DataFrame, sets: _Sets, df, n_docs: int) -> DataFrame:
    """(n, c): the class of every text that has a link; ``keys``: (key, n,
    held, support) of the buckets with two texts or more."""
    labels = None

    def relabel(new: DataFrame) -> DataFrame:
        """Classes of all links: the classes so far, as stars, and new links."""
        if labels is not None and new.isEmpty():
            return labels
        return components(new if labels is None else new.union(labels.select(F.col("n").alias("a"), F.col("c").alias("b"))))

    def with_class(k: DataFrame) -> DataFrame:
        if labels is None:
            return k.withColumn("c", F.col("n"))
        return k.join(labels, "n", "left").withColumn("c", F.coalesce("c", "n"))

    mixed = keys
    for turn in range(STARS):
        members = with_class(mixed)
        central = F.max(F.struct(F.col("support").alias("o"), "n", "c"))
        leaders = members.groupBy("key").agg(central.alias("l"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo != hi")
        members = stage(members.join(leaders.select("key", "l"), "key"), "neardup_members")
        mixed = members.select("key", "n", "held", "support")
        others = members.where("c != l.c").select("key", "n", "c", "held", F.col("l.n").alias("to"))
        if turn:
            # the central text has been met: another one leads those outside its class
            chance = F.max(F.struct(F.xxhash64(F.lit(turn), "n").alias("o"), "n", "c"))
            others = others.drop("to").join(others.groupBy("key").agg(chance.alias("l")), "key").where("c != l.c")
            others = others.select("key", "n", "held", F.col("l.n").alias("to"))
        stars = others.groupBy("n").agg(F.max_by("to", F.struct("held", "key")).alias("to"))
        labels = relabel(_verified(stars.select(F.col("n").alias("a"), F.col("to").alias("b")), side, sets, df, n_docs))

    def still_mixed(k: DataFrame) -> DataFrame:
        k = with_class(k)
        several = k.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo != hi").select("key")
        return stage(k.join(several, "key").select("key", "n", "c", "held"), "neardup_mixed")

    mixed = still_mixed(mixed)
    small = mixed.where(F.col("held") <= SMALL).join(side.drop("sig"), "n")
    small = stage(small, "neardup_small")
    x, y = small.alias("x"), small.alias("y")
    close = may_be_similar(lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}"))
    cross = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.n") < F.col("y.n")) & (F.col("x.c") != F.col("y.c")) & close)
    cross = cross.select(F.col("x.n").alias("a"), F.col("y.n").alias("b"))
    labels = relabel(_verified(cross, side, sets, df, n_docs))
    # large buckets that are still mixed: every pair that can be similar
    rest = still_mixed(mixed.where(F.col("held") > SMALL).select("key", "n", "held"))
    rest = stage(rest.select("n", "c").distinct(), "neardup_rest")
    if not rest.isEmpty():
        labels = relabel(_verified(prefix_pairs(sets.table, rest, df, n_docs), side, sets, df, n_docs, sampled=False))
    return labels


def deduplicate(docs: DataFrame) -> DataFrame:
    """The first document of every class, with the columns of ``docs``."""
    rows = numbered(docs)
    keep = stage(classes(rows.select("n", "doc.text")).where("n = class").select("n"), "neardup_kept")
    # the kept rows are as many as the documents: a shuffle join, hashed on the
    # side of the numbers, so that texts are not sorted
    return rows.join(keep.hint("shuffle_hash"), "n", "left_semi").select("doc.*")


def op3_weighted_minhash(spark, sf_dir: str) -> DataFrame:
    """One row per document: its class (least doc_id in it) and the class's size."""
    rows = numbered(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    found = classes(rows.select("n", "doc.text"))
    found = stage(rows.select("n", "doc.doc_id").join(found, "n"), "neardup_ids")
    groups = found.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return found.join(groups, "class").select("doc_id", "class_id", "class_size")
