"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a seeded shuffled order, repeated
up to ``max_epochs`` times.  A document's virtual finish time is the words its
source has sent up to and including it, divided by the source's target.  The
queues are served in order of finish time until the total budget is spent, so
every source has sent about its target when the mix ends.

The order is global, but no source passes through one task.  Inside a source
the shuffle key is a uniform hash, so fixed slices of the hash hold equal
shares of the rows; running sums are taken per slice and lifted by the sums of
earlier slices.  The global serving order is cut into slices of virtual time
in the same way.  Only narrow columns are moved, never the texts.

Defined results: null text -> size 0; null source is a source of its own, last
in order; repeated rows are separate documents; an empty table gives an empty
result; a source without words has target 0 and sends nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import buckets_for, n_words, pick
from lodestar.session import stage

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_EPOCHS = 2
SLICE_ROWS = 5_000


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_epochs: int) -> DataFrame:
    """One row per source: (source, source_size, n, weight, target).

    Weights repeat over the sources in code-point order (null last).  Target
    = min(weight * level, max_epochs * size); the level solves sum(target) =
    share * sum(size), i.e. what a full source cannot take is reshared by
    weight.  Sources are full in order of max_epochs * size / weight, so one
    running sum over that order finds the level.  The windows see one
    pre-aggregated row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    per = stage(per, "mix_sources")
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (nth % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", w)
    cap = F.col("source_size") * F.lit(max_epochs)
    full_at = cap / F.col("weight")
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    per = per.withColumn("full_at", full_at)
    # the level if exactly the sources before this one are full
    level = (
        F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    ) / F.sum("weight").over(rest)
    per = per.withColumn("level", level)
    # the first source that the level does not fill fixes it for all; from
    # there on the value only falls, so it is the largest that qualifies
    found = F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(everything)
    per = per.withColumn("level", found)
    target = F.least(cap.cast("double"), F.coalesce(F.col("weight") * F.col("level"), cap.cast("double")))
    return per.select("source", "source_size", "n", "weight", target.alias("target"))


def fair_mix(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``sizes``: (row, source, size, shuffle) with ``row`` unique and
    ``shuffle`` a uniform 64-bit key.  Returns the same rows with
    source_size, target, copies and taken (= copies * size)."""
    sizes = stage(sizes, "mix_sizes")
    rows = sizes.count()
    # one row per source; small enough to join without moving the documents
    # whenever the optimiser measures it so
    targets = stage(source_targets(sizes, weights, share, max_epochs), "mix_targets")
    budget = targets.agg(F.sum("target").alias("b")).first()
    if not rows or not budget["b"]:
        return sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).select(
            sizes["row"], sizes["source"], sizes["size"], targets["source_size"], targets["target"],
            F.lit(0).alias("copies"), F.lit(0).cast("long").alias("taken"),
        )
    t = targets.withColumnRenamed("source", "t_source")
    at = sizes.join(t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    # slices of the uniform key: about slice_rows rows each, whatever the source
    n_slices = F.ceil(F.col("n") / slice_rows)
    unit = (F.col("shuffle").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    at = at.withColumn("slice", F.least(F.floor(unit * n_slices), n_slices - 1).cast("long"))
    in_slice = Window.partitionBy("source", "slice").orderBy("shuffle", "row")
    at = at.withColumn("run", F.sum("size").over(in_slice.rowsBetween(Window.unboundedPreceding, 0)))
    at = stage(at.drop("n", "weight"), "mix_runs")
    totals = at.groupBy("source", "slice").agg(F.max("run").alias("words"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("source").alias("s_source"), F.col("slice").alias("s_slice"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("lift")
    )
    at = at.join(totals, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("slice") == F.col("s_slice")))
    sent = F.col("lift") + F.col("run")
    at = stage(at.select("row", "source", "size", "source_size", "target", sent.alias("sent")), "mix_sent")

    def finish(epoch: int) -> Column:
        return F.when(F.col("target") > 0, (F.col("source_size") * epoch + F.col("sent")) / F.col("target"))

    # the virtual time at which the budget is spent
    served = at.select("size", F.explode(F.array(*[finish(e) for e in range(max_epochs)])).alias("finish")).where("finish is not null")
    n_slots = buckets_for(rows, slice_rows)
    served = served.withColumn("slot", F.floor(F.col("finish") * n_slots))
    slots = served.groupBy("slot").agg(F.sum("size").alias("words"))
    lifted = slots.select(
        F.col("slot").alias("l_slot"),
        F.coalesce(F.sum("words").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("lift"),
        "words",
    )
    # only the slice where the running total crosses the budget must be sorted
    b = float(budget["b"])
    crossing = lifted.where(F.col("lift") <= b).where(F.col("lift") + F.col("words") > b)
    by_time = Window.partitionBy("slot").orderBy("finish")  # range frame: equal times are served together
    cut = (
        served.join(F.broadcast(crossing), F.col("slot") == F.col("l_slot"))
        .withColumn("total", F.col("lift") + F.sum("size").over(by_time))
        .agg(F.max(F.when(F.col("total") <= b, F.col("finish"))).alias("last"), F.min("slot").alias("slot"))
        .first()
    )
    if cut["slot"] is None:  # everything is taken
        taken_at = [F.col("target") > 0 for _ in range(max_epochs)]
    else:
        # everything before the crossing slice, and in it up to the cut
        last = F.lit(cut["last"]) if cut["last"] is not None else F.lit(None).cast("double")
        taken_at = [
            F.coalesce((F.floor(finish(e) * n_slots) < F.lit(cut["slot"])) | (finish(e) <= last), F.lit(False))
            for e in range(max_epochs)
        ]
    copies = sum((x.cast("int") for x in taken_at), F.lit(0))
    return at.select("row", "source", "size", "source_size", "target", copies.alias("copies")).withColumn(
        "taken", F.col("copies") * F.col("size")
    )


def document_sizes(docs: DataFrame, seed: int = 7, number: Column | None = None) -> DataFrame:
    """(row, source, size, shuffle) for fair_mix, which writes them before it
    uses them.  ``row`` holds the id and the row's ``number`` (if none is given,
    its place in the scan); ``shuffle`` depends on the id, the source and the
    text, so reruns agree."""
    number = F.monotonically_increasing_id() if number is None else number
    return pick(
        docs,
        row=F.struct(F.col("doc_id").alias("doc_id"), number.alias("n")),
        source="source",
        size=n_words("text"),
        shuffle=F.xxhash64(F.lit(seed), "doc_id", "source", "text"),
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it (0 to
    MAX_EPOCHS times), with the columns of ``docs``."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    # the number is written with the row, so every pass reads the same one
    whole = stage(docs.select(F.monotonically_increasing_id().alias("n"), doc), "mix_docs")
    fields = [F.col(f"doc.{c}").alias(c) for c in ("doc_id", "source", "text")]
    sizes = document_sizes(whole.select(F.col("n").alias("number"), *fields), number=F.col("number"))
    mixed = fair_mix(sizes).where("copies > 0").select(F.col("row.n").alias("n"), "copies")
    # as many rows as documents: a shuffle join, hashed on the narrow side, so
    # that texts are not sorted
    out = whole.join(mixed.hint("shuffle_hash"), "n").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select("doc.*")


def op7_fair_queue_mix(spark, sf_dir: str) -> DataFrame:
    """Words taken of every document when the sources, weighing 3, 1, 2 in
    turn, share 150 % of all words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = fair_mix(document_sizes(docs))
    return out.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "copies")
