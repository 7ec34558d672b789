"""Best-fit packing of token sequences after Martello-Toth reduction.

Every document becomes its token ids plus an end id.  A document longer than a
sequence is cut into pieces of a whole sequence, the shorter piece first.
Pieces are then integers from 1 to ``capacity``, so the whole packing problem
is a histogram of at most ``capacity`` counts, whatever the corpus size.  The
plan is made on that histogram:

1. reduction: for the largest remaining length, a small set of lengths that
   dominates all other sets for its sequence is fixed for good - alone if
   nothing fits beside it; with its exact complement; with the largest partner
   if no two pieces fit beside it; with the best two if no three do.  Fixing
   them does not raise the least number of sequences.
2. best fit on the rest, longest first: into the fullest sequence with room.

Both steps handle equal lengths in bulk, so the plan has a few thousand rows.
A plan row says: the pieces of a length numbered first..last go, ``per_seq``
at a time, to the sequences from ``seq`` on, at ``offset``.  Pieces get their
numbers per length from counts per scan partition: no sort and no window over
all rows of a length.

Defined results: null text -> the end id alone; an empty table -> no rows;
repeated rows are separate documents.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.session import stage

CAPACITY = 1024
END_ID = 2

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
)


def cut_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: its place in the document, length, checksum (and
    packed ids if asked), the scan partition and its number there among the
    pieces of its length."""
    schema = PIECES + (", ids binary" if with_ids else "")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from lodestar.llm.tokens import ByteBpe, packed

        bpe, end = ByteBpe(), packed([end_id])
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype="int64")
        step = 4 * capacity
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            cols: dict[str, list] = {n: [] for n in names}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = bpe.packed(text or "") + end
                first = len(ids) % step or step
                edges = [0, *range(first, len(ids) + 1, step)]
                for k in range(len(edges) - 1):
                    a, b = edges[k], edges[k + 1]
                    n = (b - a) // 4
                    row = [doc_id, k, a // 4, n, zlib.crc32(ids[a:b]), part, int(seen[n])]
                    seen[n] += 1
                    if with_ids:
                        row.append(ids[a:b])
                    for name, v in zip(names, row, strict=True):
                        cols[name].append(v)
            kinds = {"piece": pa.int32(), "part": pa.int32(), "ids": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(cols[n], kinds.get(n, pa.int64())) for n in names], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(run, schema)


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first, last, per_seq, seq, offset) from the histogram of
    piece lengths; see the module text."""
    left = {n: c for n, c in counts.items() if c > 0}
    used: dict[int, int] = defaultdict(int)  # pieces of a length numbered so far
    plan: list[tuple[int, int, int, int, int, int]] = []
    n_seq = 0

    def give(length: int, many: int, per_seq: int, seq: int, offset: int) -> None:
        plan.append((length, used[length], used[length] + many - 1, per_seq, seq, offset))
        used[length] += many
        left[length] -= many
        if not left[length]:
            del left[length]
            lengths.pop(bisect.bisect_left(lengths, length))

    lengths = sorted(left)  # lengths still open
    waiting: list[int] = []  # lengths that the reduction leaves to best fit

    def fix(members: list[int], many: int) -> None:
        nonlocal n_seq
        offset = 0
        for m in sorted(set(members), reverse=True):
            k = members.count(m)
            give(m, many * k, k, n_seq, offset)
            offset += k * m
        n_seq += many

    def most(members: list[int]) -> int:
        return min(left[m] // members.count(m) for m in set(members))

    def beside(room: int, taken: list[int]) -> int | None:
        """Largest open length up to room, with a piece free besides taken."""
        i = bisect.bisect_right(lengths, room) - 1
        while i >= 0 and left[lengths[i]] <= taken.count(lengths[i]):
            i -= 1
        return lengths[i] if i >= 0 else None

    def smallest(k: int, taken: list[int]) -> list[int] | None:
        out: list[int] = []
        for n in lengths:
            out += [n] * min(k - len(out), max(0, left[n] - taken.count(n)))
            if len(out) == k:
                return out
        return None

    top = len(lengths) - 1
    while top >= 0:
        top = min(top, len(lengths) - 1)
        if top < 0:
            break
        big = lengths[top]
        room = capacity - big
        one = beside(room, [big])
        if one is None:
            fix([big], left[big])
        elif one == room:
            fix([big, one], most([big, one]))
        else:
            two, three = smallest(2, [big]), smallest(3, [big])
            if two is None or sum(two) > room:
                fix([big, one], most([big, one]))
            elif three is None or sum(three) > room:
                # at most two fit: the largest partner with the largest second
                # dominates every pair whose smaller piece is no larger
                best = beside(room - one, [big, one])
                half = beside(room // 2, [big])
                if best is not None and (half is None or best >= half):
                    fix([big, one, best], most([big, one, best]))
                else:
                    waiting.append(big)
                    top -= 1
                    continue
            else:
                waiting.append(big)
                top -= 1
                continue
        top = bisect.bisect_right(lengths, big) - 1
        while top >= 0 and lengths[top] in waiting:
            top -= 1
    # best fit, longest first; sequences of equal room are one run [room, first, many, offset]
    rooms: list[int] = []
    runs: dict[int, list[tuple[int, int]]] = {}

    def put(room: int, seq: int, many: int) -> None:
        if many and room:
            if room not in runs:
                bisect.insort(rooms, room)
                runs[room] = []
            runs[room].append((seq, many))

    for n in sorted(left, reverse=True):
        while n in left:
            need = left[n]
            i = bisect.bisect_left(rooms, n)
            if i == len(rooms):
                per = capacity // n
                full, rest = divmod(need, per)
                if full:
                    give(n, full * per, per, n_seq, 0)
                    put(capacity - per * n, n_seq, full)
                    n_seq += full
                if rest:
                    give(n, rest, rest, n_seq, 0)
                    put(capacity - rest * n, n_seq, 1)
                    n_seq += 1
                continue
            room = rooms[i]
            seq, many = runs[room].pop()
            if not runs[room]:
                del runs[room]
                rooms.pop(i)
            per = room // n
            full = min(many, need // per)
            if full:
                give(n, full * per, per, seq, capacity - room)
                put(room - per * n, seq, full)
            rest = left.get(n, 0) if full < many else 0
            if rest:
                give(n, rest, rest, seq + full, capacity - room)
                put(room - rest * n, seq + full, 1)
                full += 1
            put(room, seq + full, many - full)
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (as from cut_pieces) with sequence_id and offset."""
    spark = pieces.sparkSession
    pieces = stage(pieces, "pieces")
    per_part = stage(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "piece_counts")
    # at most `capacity` rows
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_sequences(counts, capacity)
    rows = spark.createDataFrame(
        plan or [(0, 0, 0, 1, 0, 0)], "p_length long, first long, last long, per_seq long, seq long, at long"
    )
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    lifts = per_part.select(
        F.col("length").alias("l_length"), F.col("part").alias("l_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lift")
    )
    numbered = pieces.join(lifts, (F.col("length") == F.col("l_length")) & (F.col("part") == F.col("l_part"))).withColumn(
        "number", F.col("lift") + F.col("nth")
    )
    # the plan is bounded by the number of lengths, not by the rows
    placed = numbered.join(
        F.broadcast(rows), (F.col("length") == F.col("p_length")) & F.col("number").between(F.col("first"), F.col("last"))
    )
    k = F.col("number") - F.col("first")
    return placed.withColumn("sequence_id", F.col("seq") + F.floor(k / F.col("per_seq")).cast("long")).withColumn(
        "offset", F.col("at") + (k % F.col("per_seq")) * F.col("length")
    )


OUT = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def pack_documents(docs: DataFrame, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequences; ``with_ids`` adds the
    piece's token ids (packed little-endian unsigned 32-bit)."""
    out = pack(cut_pieces(docs, with_ids=with_ids))
    return out.select(*OUT, *(["ids"] if with_ids else []))


def op8_best_fit_pack(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
