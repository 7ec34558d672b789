"""Periodic runs of words by longest common extensions over a difference cover.

A run is a maximal stretch of words with smallest period q that repeats often
enough (``min_exponent`` periods, ``min_length`` words).  Runs of period p are
found on a harmonic grid: every run of at least ``k`` periods holds a pair of
positions (i, i + p) whose i is a multiple of (k - 1) p, so n / ((k - 1) p) pairs
are tried for each p, n log n in all.  Each pair is extended forwards and
backwards by a longest-common-extension query:

* only the suffixes that start on a difference cover (positions whose residue
  mod 21 is in ``COVER``, five of 21) are sorted, by prefix doubling;
* two positions are compared word by word for the few words (at most 20) up to
  the next place where both are on the cover; from there on the answer is a
  range minimum over the common prefixes of neighbouring sorted suffixes, read
  from a sparse table.

A stretch found under several multiples of its period is kept once, under the
smallest.  Documents are handled in groups of about ``GROUP`` words, a long
one alone; pairs in blocks of ``PAIRS``.  Nothing is shuffled.

Defined results: null, empty and blank texts have no words, no runs and an
empty collapsed text; very long texts are searched whole, in one task each;
of equal stretches the smallest period counts, and runs are listed by start,
then period; repeated rows give a row each; an empty table gives an empty
result; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import bind, words

COVER_PERIOD = 21
COVER = (3, 6, 7, 12, 14)  # every difference mod 21 occurs
GROUP = 1 << 18
PAIRS = 1 << 20
MIN_LENGTH, MIN_EXPONENT = 6, 4
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def shifts():
    """For residues (a, b): the least step that puts both on the cover."""
    import numpy as np

    v, on = COVER_PERIOD, set(COVER)
    step = lambda a, b: next(t for t in range(v) if (a + t) % v in on and (b + t) % v in on)
    return np.array([[step(a, b) for b in range(v)] for a in range(v)])


class CommonExtensions:
    """How far the words from two positions of one document agree.

    ``words``: non-negative ids of several documents one after another, each
    ended by an id that occurs nowhere else; ``owner``: the document of each."""

    def __init__(self, words, owner):
        import numpy as np

        n, v = len(words), COVER_PERIOD
        self._words = np.concatenate((words, np.zeros(v, words.dtype)))
        self._shift = shifts()
        on_cover = np.zeros(v, bool)
        on_cover[list(COVER)] = True
        at = np.flatnonzero(on_cover[np.arange(n) % v])
        self._number = np.full(n + 1, -1, "int32")
        self._number[at] = np.arange(len(at))
        levels = self._sort(at, owner[at], n)
        self._place = levels[-1][1]
        order = np.empty(len(at), "int64")
        order[self._place] = np.arange(len(at))
        self._table = self._minima(self._neighbours(at[order], owner[at[order]], levels, n))

    def _sort(self, at, owner, n: int) -> list:
        """(words compared, rank of each sampled suffix), doubled until all
        ranks differ; suffixes of a document stay together."""
        import numpy as np

        bits = max(int(self._words.max()).bit_length(), 1)
        keys, per = [owner], max(62 // bits, 1)
        for a in range(0, COVER_PERIOD, per):
            key = np.zeros(len(at), "int64")
            for b in range(a, min(a + per, COVER_PERIOD)):
                key = key << bits | self._words[at + b]
            keys.append(key)
        order = np.lexsort(keys[::-1])

        def ranks(order, keys):
            differs = np.zeros(len(order), bool)
            for key in keys:
                differs[1:] |= key[order[1:]] != key[order[:-1]]
            rank = np.empty(len(order), "int64")
            rank[order] = np.cumsum(differs)
            return rank

        length, rank = COVER_PERIOD, ranks(order, keys)
        levels = [(length, rank)]
        while rank.max() + 1 < len(at):
            then = self._number[np.minimum(at + length, n)]
            key = rank * (len(at) + 1) + np.where(then >= 0, rank[then] + 1, 0)
            rank = ranks(np.argsort(key, kind="stable"), [key])
            length *= 2
            levels.append((length, rank))
        return levels

    def _neighbours(self, at, owner, levels, n: int):
        """Common words of each sorted suffix and the next."""
        import numpy as np

        x, y, same = at[:-1], at[1:], owner[:-1] == owner[1:]
        common = np.zeros(len(x), "int64")
        for length, rank in reversed(levels[:-1]):
            i, j = self._number[np.minimum(x + common, n)], self._number[np.minimum(y + common, n)]
            common += length * (same & (i >= 0) & (j >= 0) & (rank[i] == rank[j]))
        return common + self._compare(x + common, y + common, np.where(same, COVER_PERIOD, 0))

    def _minima(self, common):
        import numpy as np

        rows = [common.astype("int32")]
        width = 1
        while 2 * width <= len(common):
            last, row = rows[-1], rows[-1].copy()
            row[: len(common) - width] = np.minimum(last[:-width], last[width:])
            rows.append(row)
            width *= 2
        return np.stack(rows)

    def _compare(self, x, y, most):
        """Equal words from x and y on, at most ``most`` of them."""
        import numpy as np

        out = np.zeros(len(x), "int64")
        live = np.flatnonzero(most > 0)
        step = 0
        while len(live):
            live = live[self._words[x[live] + step] == self._words[y[live] + step]]
            out[live] += 1
            step += 1
            live = live[most[live] > step]
        return out

    def extend(self, x, y):
        """Equal words from positions x < y (arrays) on."""
        import numpy as np

        near = self._shift[x % COVER_PERIOD, y % COVER_PERIOD]
        out = self._compare(x, y, near)
        far = np.flatnonzero(out == near)
        i = self._place[self._number[x[far] + near[far]]]
        j = self._place[self._number[y[far] + near[far]]]
        low, high = np.minimum(i, j), np.maximum(i, j)
        level = np.frexp((high - low).astype("float64"))[1] - 1
        out[far] += np.minimum(self._table[level, low], self._table[level, high - (1 << level)])
        return out


def grid(starts, lengths, min_length: int, min_exponent: int) -> Iterator:
    """Pairs (i, p) of the harmonic grid of every document, in blocks."""
    import numpy as np

    most = np.where(lengths >= min_length, lengths // min_exponent, 0)
    doc = np.repeat(np.arange(len(starts)), most)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = (min_exponent - 1) * period
    tries = (lengths[doc] - period - 1) // step + 1
    ends = np.cumsum(tries)
    a = 0
    while a < len(doc):
        b = max(int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PAIRS, "right")), a + 1)
        n = tries[a:b]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(starts[doc[a:b]], n) + nth * np.repeat(step[a:b], n), np.repeat(period[a:b], n)
        a = b


def find_runs(words, starts, lengths, owner, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT):
    """(start, length, period) arrays of all runs, by start, then period.
    ``words``: an ending id, then each document's ids and its ending id."""
    import numpy as np

    n = len(words)
    none = np.zeros(0, "int64")
    forward = backward = None
    found = []
    for i, p in grid(starts, lengths, min_length, min_exponent):
        equal = words[i] == words[i + p]
        i, p = i[equal], p[equal]
        if not len(i):
            continue
        if forward is None:
            forward = CommonExtensions(words, owner)
            backward = CommonExtensions(words[::-1].copy(), owner[::-1].copy())
        ahead, behind = forward.extend(i, i + p), backward.extend(n - i - p, n - i)
        length = ahead + behind + p
        long = length >= np.maximum(min_length, min_exponent * p)
        found.append(np.stack((i - behind, length, p))[:, long])
    if not found:
        return none, none, none
    start, length, period = np.unique(np.concatenate(found, axis=1), axis=1)
    # columns are sorted by start, length, period: the first of a stretch has the smallest
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """(doc_id, runs, collapsed) per row: its runs (start word, length, period)
    and the words joined by one space without those that lie in a run after
    its first period."""

    def collapse(texts: list) -> Iterator:
        """(runs as (start, length, period) arrays, collapsed bytes) per text."""
        import numpy as np

        lengths = np.array([len(t) for t in texts])
        ids = defaultdict(count().__next__)
        flat = [ids[w] for t in texts for w in t]
        last = len(ids)
        starts = np.cumsum(lengths + 1) - lengths
        words = np.empty(int((lengths + 1).sum()) + 1, "int64")
        inside = np.ones(len(words), bool)
        ends = np.append(starts - 1, len(words) - 1)
        inside[ends] = False
        words[inside] = flat
        words[ends] = last + np.arange(len(ends))
        owner = np.repeat(np.arange(len(texts) + 1), np.append(1, lengths + 1))
        start, length, period = find_runs(words, starts, lengths, owner, min_length, min_exponent)
        delta = np.zeros(len(words) + 1, "int64")
        np.add.at(delta, start + period, 1)
        np.add.at(delta, start + length, -1)
        dropped = np.cumsum(delta) > 0
        cuts = np.searchsorted(start, np.append(starts, len(words)))
        for k, text in enumerate(texts):
            a, b, s = cuts[k], cuts[k + 1], starts[k]
            if a < b:
                kept = [text[x] for x in np.flatnonzero(~dropped[s : s + lengths[k]])]
                yield start[a:b] - s, length[a:b], period[a:b], b" ".join(kept)
            else:
                yield start[:0], length[:0], period[:0], b" ".join(text)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out, texts, held = [], [], 0
            for raw in batch.column(1):
                texts.append(raw.as_py().split())  # bytes split at the six ASCII spaces
                held += len(texts[-1])
                if held >= GROUP:
                    out.extend(collapse(texts))
                    texts, held = [], 0
            if texts:
                out.extend(collapse(texts))
            runs = pa.StructArray.from_arrays(
                [pa.array(np.concatenate([o[i] for o in out]).astype("int64")) for i in range(3)], names=["start", "length", "period"]
            )
            offsets = np.cumsum([0] + [len(o[0]) for o in out])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs), pa.array([o[3] for o in out], pa.binary()).cast(pa.string())],
                names=["doc_id", "runs", "collapsed"],
            )

    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {kind}, runs array<{RUN}>, collapsed string")


def looped_text(doc_id: str, text: str) -> Column:
    """The text, in one of ten documents with its words from a place on
    replaced by a cycle: word i >= a becomes word a + (i - a) % p, where h is
    the checksum of the id, g = h div 10, a = g % n, p = 1 + (n - a) div (3 + g % 8)."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def cycle(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        again = F.transform(F.sequence(F.lit(0), n - a - 1), lambda i: F.element_at(w, a + i % p + 1))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a), again), " ")).otherwise("")

    return F.when(h % 10 == 0, bind(words(text), cycle)).otherwise(F.col(text))


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of at least four periods and six words in all documents, one of ten
    documents looped: their number, the longest, and digests of all runs and
    of the collapsed text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", looped_text("doc_id", "text").alias("text"))
    found = periodic_runs(docs)
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    out = found.select("doc_id", "collapsed", F.size("runs").cast("long").alias("n_runs"), longest.alias("best"), F.array_join(lines, "").alias("listed"))
    start, length, period = F.col("best.s"), -F.col("best.l"), F.col("best.p")
    return out.select(
        "doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
