"""The corpus pipeline: stages over ``documents``, each written as Parquet and
read again as the next one's input."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm.mixing import mix_documents
from lodestar.llm.neardup import deduplicate
from lodestar.llm.packing import pack_documents
from lodestar.llm.pii import redact_documents
from lodestar.llm.quality import quality_documents
from lodestar.session import checkpoint_root, staging


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep.

    Null, empty and very short texts fail the base rule and go; very long texts
    are judged whole; repeated rows are judged each, alike; of rules that fit
    the first one decides; an empty table, or one without labels, is judged by
    the base rule only; other columns are kept."""
    return quality_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near copies: its first row.

    Null texts are one class, and so are equal empty or blank texts; very long
    texts are compared whole; repeated rows are one class; an empty table stays
    empty; other columns are kept."""
    return deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the name of its kind.

    Null texts stay null and empty ones empty; very long texts are searched
    whole; of spans that overlap the strict kinds win; repeated rows are
    redacted each; an empty table stays empty; other columns are kept."""
    return redact_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources by target weights; a document taken twice is there twice.

    Null and empty texts have no words and follow their source's order; a null
    source is a source of its own, the last; very long texts count whole; equal
    rows are separate documents; documents with equal finish times are taken
    together; an empty table stays empty; other columns are kept."""
    return mix_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in the training sequences.

    Null and empty texts are one end token; very long texts are cut into whole
    sequences; repeated rows are packed each; which of equally long pieces comes
    where depends on their place in the scan only; an empty table gives no
    pieces; other columns are dropped."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

# Learned rules, minhashes and tokenizers have no SQL form; the stages are
# tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    out = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{checkpoint_root(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        with staging(spark):  # what the stage has staged goes when its result is written
            stage(spark, out, sf_dir).write.parquet(f"{root}/{k}-{name}")
        out = spark.read.parquet(f"{root}/{k}-{name}")
    return out
