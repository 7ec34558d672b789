"""Sharding by Hilbert-curve order [native].

Several metadata columns are quantised to ``bits`` bits each (strings by the
rank of whole counted values), the cell's index
on the n-dimensional Hilbert curve orders the rows, and the order is cut into
runs.  Rows near each other in every dimension end up in the same shard, so a
filter on any of the dimensions prunes files by their min/max statistics.

Rows are ranked by a range partitioning on (curve index, tie-break columns,
row number): a hot cell spreads over many partitions, no task holds a whole
shard, and only the narrow columns that the caller passes are moved.

Defined results: null dimension -> cell 0; null text -> size 1 and crc 0; very
long texts count whole; rows equal in curve index and tie-break columns are
ordered by their place in the scan; repeated rows keep one slot each; an empty table gives an empty result; input
columns named like the output (``shard``, ``slot``) are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import prefix_sum, utf8_bytes
from lodestar.operators.order_stats import running_sums
from lodestar.session import stage


def curve_tables(n: int) -> tuple[list[int], list[int]]:
    """Digit and next-state tables of the n-dimensional Hilbert curve.

    A state is (entry corner e, axis d); reading the corner bits ``c`` of one
    level emits the digit ``w`` whose Gray code is the corner seen from that
    state, then turns the state.  Entry [state * 2**n + corner]."""
    size, mask = 1 << n, (1 << n) - 1

    def turn(x: int, by: int) -> int:
        by %= n
        return ((x << by) | (x >> (n - by))) & mask

    def rank(gray: int) -> int:
        out = 0
        while gray:
            out ^= gray
            gray >>= 1
        return out

    def entry(w: int) -> int:
        k = 2 * ((w - 1) // 2) if w else 0
        return k ^ (k >> 1)

    def axis(w: int) -> int:
        if w == 0:
            return 0
        x = w if w % 2 else w - 1
        return (((x + 1) & ~x).bit_length() - 1) % n

    digits, states = [], []
    for state in range(size * n):
        e, d = state // n, state % n
        for corner in range(size):
            w = rank(turn(corner ^ e, n - (d + 1) % n))
            digits.append(w)
            states.append((e ^ turn(entry(w), d + 1)) * n + (d + axis(w) + 1) % n)
    return digits, states


def hilbert_index(cells: Sequence[Column], bits: int) -> Column:
    """Position of the cell (one ``bits``-bit integer per dimension) on the curve."""
    n = len(cells)
    digits, states = curve_tables(n)
    digit_t, state_t = (F.array(*[F.lit(v) for v in t]) for t in (digits, states))

    def level(acc: Column, i: Column) -> Column:
        corner = sum(
            (F.call_function("shiftright", c, i).bitwiseAND(F.lit(1)) * (1 << j) for j, c in enumerate(cells)), F.lit(0)
        )
        at = acc["s"] * (1 << n) + corner + 1
        return F.struct(F.element_at(state_t, at).alias("s"), (acc["h"] * (1 << n) + F.element_at(digit_t, at)).alias("h"))

    start = F.struct(F.lit(0).alias("s"), F.lit(0).cast("long").alias("h"))
    return F.aggregate(F.array(*[F.lit(i) for i in reversed(range(bits))]), start, level)["h"]


def order_key(df: DataFrame, name: str) -> Column:
    """What orders like the column: whole strings, and a double for anything else."""
    kind = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        return c.cast("string")
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return F.unix_timestamp(c).cast("double")
    return c.cast("double")


def string_borders(df: DataFrame, name: str, parts: int) -> list[str]:
    """At most ``parts`` - 1 values that cut the column into runs of about equal
    frequency: values are counted first, and their counts summed in order by a
    distributed running sum."""
    counted = df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("v")).agg(F.count("*").alias("n"))
    counted = running_sums(counted, ["v"], ["n"], prefix="upto_", inclusive=True)
    total = counted.agg(F.sum("n").alias("n")).first()["n"]
    if not total:
        return []
    passed = lambda upto: F.floor(upto * parts / F.lit(total))
    cut = (passed(F.col("upto_n")) > passed(F.col("upto_n") - F.col("n"))) & (F.col("upto_n") < total)
    return sorted((r["v"] for r in counted.where(cut).select("v").collect()), key=str.encode)  # fewer than ``parts`` rows


def assign_shards(
    df: DataFrame,
    dims: Sequence[str],
    ties: Sequence[str],
    n_shards: int = 8,
    bits: int = 5,
    accuracy: int = 10_000,
) -> DataFrame:
    """``df`` with ``shard`` (0..n_shards-1) and ``slot`` (gapless from 0 in
    its shard).  Law: counts of any two shards differ by at most one."""
    spark = df.sparkSession
    keep = [c for c in df.columns if c not in ("shard", "slot")]
    keyed = df.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        F.struct(*[F.col(f"`{c}`") for c in ties]).alias("tie"),
        *[order_key(df, d).alias(f"d{j}") for j, d in enumerate(dims)],
    )
    keyed = stage(keyed, "hilbert_rows")
    # equal-frequency cell borders: at most 2**bits - 1 values per dimension
    probs = [k / (1 << bits) for k in range(1, 1 << bits)]
    texts = [j for j in range(len(dims)) if isinstance(keyed.schema[f"d{j}"].dataType, T.StringType)]
    numbers = [j for j in range(len(dims)) if j not in texts]
    borders = {j: string_borders(keyed, f"d{j}", 1 << bits) for j in texts}
    if numbers:
        found = keyed.agg(*[F.percentile_approx(f"d{j}", probs, accuracy).alias(f"d{j}") for j in numbers]).first()
        borders |= {j: sorted(set(found[f"d{j}"] or [])) for j in numbers}

    def cell(j: int) -> Column:
        kind = "string" if j in texts else "double"
        cuts = F.array(*[F.lit(b) for b in borders[j]]).cast(f"array<{kind}>")
        return F.coalesce(F.size(F.filter(cuts, lambda b: b < F.col(f"d{j}"))), F.lit(0))

    cells = keyed.select("row", "tie", *[cell(j).alias(f"c{j}") for j in range(len(dims))])
    placed = cells.select("row", "tie", hilbert_index([F.col(f"c{j}") for j in range(len(dims))], bits).alias("h"))
    # the row number splits even fully equal rows over partitions
    placed = placed.withColumn("n", F.monotonically_increasing_id())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = (
        placed.repartitionByRange(parts, "h", "tie", "n")
        .sortWithinPartitions("h", "tie", "n")
        .select("row", F.monotonically_increasing_id().alias("at"))
    )
    ranked = stage(ranked, "hilbert_order")
    # one row per range partition: bounded by the partition setting
    counts = stage(ranked.groupBy(F.shiftright("at", 33).alias("p")).agg(F.count("*").alias("n")), "hilbert_counts")
    offsets = prefix_sum(counts, [], "p", "n", "before").select("p", "before")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    cuts = [total * i // n_shards for i in range(n_shards)]
    shard, first = F.lit(0), F.lit(cuts[0])
    for i in range(1, n_shards):
        shard = F.when(F.col("rank") >= cuts[i], i).otherwise(shard)
        first = F.when(F.col("rank") >= cuts[i], F.lit(cuts[i])).otherwise(first)
    low = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ranked.withColumn("p", F.shiftright("at", 33))
        .join(F.broadcast(offsets), "p")
        .select("row", (F.col("before") + low).alias("rank"))
        .select("row.*", shard.cast("int").alias("shard"), (F.col("rank") - first).cast("long").alias("slot"))
    )


def op9_hilbert_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in eight shards along the curve over source, language and
    size, by the law ``rows``; equal texts are neighbours within a cell."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    narrow = docs.select(
        "doc_id",
        "source",
        "lang",
        (utf8_bytes("text") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
    )
    out = assign_shards(narrow, ["source", "lang", "size"], ["text_crc32", "doc_id"], n_shards=8)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
