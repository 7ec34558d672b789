"""Profile, catalog, ranking and selection reports on the driver's tables.

Each function is ``(spark, sf_dir) -> DataFrame``; the column names are the
contract with the SQL oracle in ``plans.catalog``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators import profile as P
from lodestar.operators import rank as R
from lodestar.operators.encode import fit_labels
from lodestar.operators.order_stats import exact_sample
from lodestar.operators.scale import min_max
from lodestar.operators.select import prune_correlated
from lodestar.operators.split import stratified_split
from lodestar.sources import io


def _t(spark, sf_dir, name):
    return io.read_table(spark, sf_dir, name)


def _profile(df: DataFrame) -> DataFrame:
    p = P.column_profile(df)
    return p.withColumn("median", F.round("median", 6)).withColumn("std", F.round("std", 6))


def profile_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(_t(spark, sf_dir, "customer"))


def profile_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(_t(spark, sf_dir, "events"))


def value_counts_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.value_counts(_t(spark, sf_dir, "documents"), "lang")


def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class distribution per label column, with percentage."""
    labels = _t(spark, sf_dir, "labels")
    long = labels.unpivot([], ["quality", "toxic"], "task", "class")
    counts = long.groupBy("task", "class").agg(F.count(F.lit(1)).alias("n"))
    totals = long.groupBy("task").agg(F.count(F.lit(1)).alias("_t"))
    return counts.join(totals, "task").select(
        "task", "class", "n", F.round(F.col("n") * 100.0 / F.col("_t"), 4).alias("pct")
    )


LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def corr_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: rounded Pearson pairs (``+ 0.0`` folds a rounded -0.0 into 0.0)."""
    pairs = P.corr_pairs(_t(spark, sf_dir, "lineitem"), LINE_FEATURES, digits=2)
    return pairs.withColumn("r", F.col("r") + F.lit(0.0))


def label_codes_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_labels(_t(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


def minmax_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *LINE_FEATURES)
    scaled, _ = min_max(li, LINE_FEATURES)
    return scaled.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in LINE_FEATURES])


def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact per-class test/train sizes of the stratified split."""
    s = stratified_split(_t(spark, sf_dir, "labels"), "quality", ["doc_id"], test_size=0.2, seed=42)
    return s.groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("split") == "test", 1).otherwise(0)).cast("long").alias("n_test"),
        F.sum(F.when(F.col("split") == "train", 1).otherwise(0)).cast("long").alias("n_train"),
    )


def sample_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exact 500-row seeded sample (size checked; membership is
    engine-specific hashing)."""
    s = exact_sample(_t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"), 500, seed=42)
    return s.agg(F.count(F.lit(1)).alias("n_sampled"))


def table_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.table_registry(spark, {t: _t(spark, sf_dir, t) for t in io.TABLES})


def largest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.largest_table(table_registry(spark, sf_dir))


TAGGED = ["customer", "supplier", "nation"]


def tagged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan over several files, rows tagged by file-name stem."""
    df = io.read_tagged(spark, [io.table_path(sf_dir, t) for t in TAGGED], tag_col="tag", pattern=r"^([^.]+)\.parquet$")
    return df.groupBy("tag").agg(F.count(F.lit(1)).alias("n_rows"))


def candidate_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per query (language, in sorted order) up to two refs (sources)
    in result order (doc id), skipping refs claimed by an earlier query."""
    docs = _t(spark, sf_dir, "documents").select("lang", "source", "doc_id")
    # the query list is configuration-sized (distinct languages)
    langs = [r["lang"] for r in docs.select("lang").distinct().orderBy("lang").collect()]
    return io.select_candidates(docs, "lang", "source", "doc_id", 2, langs)


def top_parts_per_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: five most expensive parts per brand."""
    part = _t(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_retailprice")
    return R.top_k(part, 5, "p_retailprice", within=["p_brand"], tie=["p_partkey"])


def running_best_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type, the best daily value so far (day order)."""
    ev = _t(spark, sf_dir, "events").select("event_type", F.dayofmonth("ts").alias("day"), "value")
    return R.running_best(ev, "day", ["value"], within=["event_type"])


def pruned_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T10 (+T9 ordering): importance = |corr(feature, returned)| as a
    deterministic stand-in for model importances; drop the weaker member of
    every pair with |r| > 0.95."""
    li = _t(spark, sf_dir, "lineitem").withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    imp = li.agg(*[F.abs(F.corr(F.col(c), F.col("returned"))).alias(c) for c in LINE_FEATURES])
    stack = ", ".join(f"'{c}', `{c}`" for c in LINE_FEATURES)
    importance = imp.selectExpr(f"stack({len(LINE_FEATURES)}, {stack}) as (feature, importance)")
    importance = importance.withColumn("importance", F.round("importance", 6))
    pairs = P.corr_pairs(li, LINE_FEATURES + ["returned"], digits=2)
    return prune_correlated(pairs, importance, threshold=0.95, min_importance=0.001)


DERIVED = {"net_price": "l_extendedprice * (1 - l_discount)", "gross_price": "l_extendedprice * (1 - l_discount) * (1 + l_tax)", "half_quantity": "l_quantity / 2"}


def pruned_correlated_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T10 where it prunes: prices derived from one another are correlated above
    0.95, and only the most important of them stays."""
    li = _t(spark, sf_dir, "lineitem").selectExpr(*LINE_FEATURES, *[f"{e} as {c}" for c, e in DERIVED.items()], "cast(l_returnflag = 'R' as int) as returned")
    names = [*LINE_FEATURES, *DERIVED]
    pairs = P.corr_pairs(li, [*names, "returned"], digits=6)
    importance = pairs.where("b = 'returned'").select(F.col("a").alias("feature"), F.abs("r").alias("importance"))
    return prune_correlated(pairs, importance, threshold=0.95, min_importance=0.0)


# ----------------------------------------------------------------- sources round trips
def _scratch(spark: SparkSession, tag: str) -> str:
    import uuid

    from lodestar.session import checkpoint_root

    return f"{checkpoint_root(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table through a latin-1 CSV sink and an
    encoding-aware CSV scan (inferred types), summarised per segment."""
    path = _scratch(spark, "csv")
    cust = _t(spark, sf_dir, "customer")
    io.write_table(cust, path, fmt="csv", encoding="ISO-8859-1")
    back = io.read_csv(spark, path, encoding="ISO-8859-1")
    return back.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("acctbal_sum"), F.max("c_custkey").alias("max_key")
    )


# texts that a CSV file has to quote, and one that reads as missing
HARD_TEXT = """case doc_id % 5 when 0 then 'NA' when 1 then concat('say "', source, '", twice') when 2 then concat('one', chr(10), 'two, ', source)
when 3 then concat('  ', source, '  ') else text end"""


def csv_hard_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes, commas, line breaks, blanks, whole texts and an NA token
    through the CSV sink and scan; digests of what comes back."""
    path = _scratch(spark, "csv")
    io.write_table(_t(spark, sf_dir, "documents").selectExpr("doc_id", "lang", f"{HARD_TEXT} as hard"), path, fmt="csv")
    back = io.read_csv(spark, path, schema="doc_id long, lang string, hard string")
    return back.select("doc_id", "lang", F.md5(F.col("hard").cast("binary")).alias("digest"))


LOADED = ["nation", "region", "supplier"]


def catalog_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files loaded as catalog tables (sanitized names, replace
    mode, per-file failure isolation) and the registry of what loaded."""
    root = _scratch(spark, "raw")
    paths = {}
    for t in LOADED:
        p = f"{root}/{t.title()} Data.csv"
        _t(spark, sf_dir, t).write.mode("overwrite").option("header", True).csv(p)
        paths[t] = p
    paths["broken"] = f"{root}/missing.csv"  # fails; its registry row holds the error
    reg = io.load_tables(spark, paths, database="lodestar_raw")
    reg = reg.where("error is null")
    scanned = {r["table"]: spark.table(f"lodestar_raw.{r['table']}").count() for r in reg.collect()}  # S9 scans
    rows = reg.select("table", "rows", F.size("cols").cast("long").alias("n_cols"))
    check = spark.createDataFrame(list(scanned.items()), "table string, scanned long")
    return rows.join(check, "table")


def label_lists_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted label lists written as JSON and read back."""
    path = _scratch(spark, "labels-json")
    d = fit_labels(_t(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])
    # a JSON row per label, in order: no list of all labels is built anywhere
    d.repartitionByRange("column", "code").sortWithinPartitions("column", "code").write.mode("overwrite").json(path)
    return spark.read.schema("column string, label string, code int").json(path)


def describe_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """count/mean/std/min/max per numeric column."""
    d = P.describe(_t(spark, sf_dir, "lineitem"), LINE_FEATURES)
    return d.select("column", "count", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"),
                    (F.col("min") + 0.0).alias("min"), (F.col("max") + 0.0).alias("max"))


def user_unit_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User units (raw views, comments per 1000 views) converted to the
    model's units (log views, comment rate) before scoring."""
    from lodestar.functions import exprs as X

    docs = _t(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("views"),
                                                   (F.col("n_chars") % 97).alias("comments_per_1000"))
    return docs.select("doc_id", F.round(X.log1p("views"), 8).alias("log_views"),
                       X.per_thousand_to_rate("comments_per_1000").alias("comment_rate"))
