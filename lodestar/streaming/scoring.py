"""Structured Streaming scoring (M19 on a stream).

Fitted Spark ML transformers are row-local, so ``batch_score`` applies to a
streaming DataFrame unchanged.  Files arriving in a folder are scored
incrementally; the sink is an idempotent per-batch parquet write keyed by
the batch id, and progress lives in the checkpoint folder, so a restarted
query resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lodestar.models.score import Bundle, batch_score
from lodestar.session import checkpoint_root


def score_stream(
    spark: SparkSession,
    source_dir: str,
    schema,
    bundle: Bundle,
    out_dir: str,
    keep: Sequence[str] = (),
    max_files_per_trigger: int = 64,
    available_now: bool = True,
):
    """Start (and, with ``available_now``, drain) a scoring stream from
    parquet files in ``source_dir`` to parquet under ``out_dir``."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir)
    scored = batch_score(stream, bundle, keep=keep)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    writer = scored.writeStream.foreachBatch(write_batch).option(
        "checkpointLocation", f"{checkpoint_root(spark).rstrip('/')}/streams/{out_dir.strip('/').replace('/', '_')}"
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query
