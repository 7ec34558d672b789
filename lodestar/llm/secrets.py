"""Secret scan with corpus-wide ownership frequency [native].

Candidates are found by pattern in every whole text.  A candidate's value is
hashed, and the hash is counted over the corpus by distinct repositories and
owners: a value that many owners hold is a widely copied example, a value of
one owner looks live.  Counting first reduces to one row per (hash, owner,
repository) in the map tasks, so a value that a third of all documents hold is
no hot group; only hashes and narrow spans are moved, never texts or secrets.

Base kinds are always reported.  The method adds vendor-token spans (``added``
kinds) when their value is owner-specific.

Defined results: null text -> no spans; null owner counts as one owner;
repeated rows are scanned each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import let, pick
from lodestar.llm.spans import of_kind, overlaps_any, rendered, with_spans
from lodestar.session import stage

KINDS = ("assign", "access", "hex", "pem", "vendor", "jwt")
BASE = 3
# The base patterns, and public formats of vendor tokens.
PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"[0-9a-f]{16,}",
    "pem": r"-----BEGIN (?:[A-Z]{2,12} )?PRIVATE KEY-----",
    "vendor": r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{20,}|glpat-[A-Za-z0-9_-]{20,}|sk_live_[A-Za-z0-9]{20,})",
    "jwt": r"\beyJ[A-Za-z0-9_-]{16,}\.eyJ[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}",
}
MIN_VALUE = 12  # characters of an assigned value
MAX_OWNERS = 1  # more owners than this make a value an example
MAX_REPOSITORIES = 2


def _value(kind: str):
    if kind == "assign":
        return lambda v: F.regexp_extract(v, PATTERNS["assign"], 1)
    return lambda v: v


def _hashed(spans: Column, value) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"], s["k"], s["end"], F.sha2(value(s["value"]), 256).alias("hash")))


def scan(docs: DataFrame, owner: str = "source", repository: str | None = None) -> DataFrame:
    """(doc_id, owner, repository, base, added): spans with the hash of the
    secret value in place of the value."""
    d = pick(
        docs,
        doc_id="doc_id",
        owner=F.col(owner),
        repository=F.col(repository) if repository else F.concat_ws("/", F.col(owner), F.col("lang")),
        text=F.coalesce(F.col("text"), F.lit("")),
    )
    d = with_spans(d, "text", PATTERNS, {"assign": lambda v: F.length(_value("assign")(v)) >= MIN_VALUE})
    kinds = [_hashed(F.col(f"found.{k}"), _value(k)) for k in KINDS]
    d = let(d, "base", F.concat(*kinds[:BASE]))
    added = F.filter(F.concat(*kinds[BASE:]), lambda s: ~overlaps_any(s, F.col("base")))
    return d.select("doc_id", "owner", "repository", "base", added.alias("added"))


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories) from (hash, owner, repository) rows."""
    distinct = candidates.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    by_owner = distinct.groupBy("hash", "owner").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repositories"))


def scan_secrets(docs: DataFrame, owner: str = "source", repository: str | None = None) -> DataFrame:
    """One row per document: doc_id, base (spans), live and examples (spans of
    base and added kinds, by the ownership of their values)."""
    # the number is written with the row: both sides of the join below read it
    found = stage(scan(docs, owner, repository).withColumn("row", F.monotonically_increasing_id()), "secret_spans")
    single = found.select(
        "row", "owner", "repository", F.explode(F.concat("base", "added")).alias("s")
    ).select("row", "owner", "repository", "s", F.col("s.hash").alias("hash"))
    verdicts = ownership(single.select("hash", "owner", "repository"))
    live = (F.col("n_owners") <= MAX_OWNERS) & (F.col("n_repositories") <= MAX_REPOSITORIES)
    judged = single.join(verdicts, "hash").select("row", "s", live.alias("live"))
    place = F.struct(F.col("s.start"), F.col("s.k"), F.col("s.end"))
    per_row = judged.groupBy("row").agg(
        F.collect_list(F.when(F.col("live"), place)).alias("live"), F.collect_list(F.when(~F.col("live"), place)).alias("examples")
    )
    empty = F.expr("cast(array() as array<struct<start:int,k:int,end:int>>)")
    return found.join(per_row, "row", "left").select(
        "doc_id",
        F.transform("base", lambda s: F.struct(s["start"], s["k"], s["end"])).alias("base"),
        F.coalesce("live", empty).alias("live"),
        F.coalesce("examples", empty).alias("examples"),
    )


def op4_secret_ownership(spark, sf_dir: str) -> DataFrame:
    """Secrets in all documents; a source is an owner, its languages are the
    repositories."""
    out = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base, kept = F.col("base"), F.concat("base", F.filter("live", lambda s: s["k"] >= BASE))
    return out.select(
        "doc_id",
        *[of_kind(base, i).alias(f"n_{k}") for i, k in enumerate(KINDS[:BASE])],
        F.sha2(rendered(base, KINDS), 256).alias("base_sha256"),
        rendered(kept, KINDS).alias("spans"),
        F.size("live").cast("long").alias("n_live"),
        F.size("examples").cast("long").alias("n_examples"),
        rendered(F.col("live"), KINDS).alias("live_spans"),
    )


