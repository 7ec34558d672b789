"""Feature-table jobs (F1-F9) on the driver's tables.

Each job is the reference's task re-aimed at the TPC-H-like tables (see the
stand-in table in SURVEY section 5); the operator chain is the same:
scan -> filter/clip -> join -> group statistics -> flag -> encode -> impute.
Every function is ``(spark, sf_dir) -> DataFrame`` and lazy until its
statistics need a pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import exprs as X
from lodestar.operators.encode import apply_labels, encode, fit_labels
from lodestar.operators.group_stats import group_stat_flag, median_flag
from lodestar.operators.order_stats import group_quantiles
from lodestar.operators.scale import impute_median
from lodestar.session import stage, stage_bounded
from lodestar.sources.io import read_table

# Fixed values that must match the reference: video category id -> name
# (ids missing here are shown as "Category <id>").
CATEGORY_NAMES = {
    1: "Film & Animation", 2: "Autos & Vehicles", 10: "Music",
    15: "Pets & Animals", 17: "Sports", 18: "Short Movies",
    19: "Travel & Events", 20: "Gaming", 21: "Videoblogging",
    22: "People & Blogs", 23: "Comedy", 24: "Entertainment",
    25: "News & Politics", 26: "Howto & Style", 27: "Education",
    28: "Science & Technology", 29: "Nonprofits & Activism",
}
CATEGORY_FALLBACK = "Category %s"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# --------------------------------------------------------------------------
# Market position (group median after a harmonised union)
# --------------------------------------------------------------------------
def market_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """two differently shaped sources harmonised and unioned, then each
    row flagged as above its state's median price (median after the union).

    customer plays the first source (its own area label), supplier the
    second (area from a CASE bucket, lot imputed with the first source's
    median)."""
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cust = _t(spark, sf_dir, "customer")
    supp = _t(spark, sf_dir, "supplier")

    first = (
        cust.where(X.between_exclusive("c_acctbal", 0, 9000) & X.between_inclusive("c_nationkey", 1, 23))
        .join(nation, cust.c_nationkey == nation.n_nationkey, "left")
        .select(
            F.col("c_name").alias("name"),
            F.col("c_acctbal").alias("price"),
            F.col("n_name").alias("state"),
            F.lower("c_mktsegment").alias("area_type"),
            X.clip(F.col("c_acctbal") / F.lit(1000.0), 0.0, 5.0).alias("lot"),
        )
        .na.drop(subset=["price", "state", "area_type"])
        .withColumn("country_flag", F.lit("C"))
    )
    # both medians (the first source's lot, and price per state after the
    # union) come from one sorted pass; price rows do not depend on lot
    second = (
        supp.where(X.between_exclusive("s_acctbal", -500, 9500) & X.between_inclusive("s_nationkey", 0, 24))
        .join(nation, supp.s_nationkey == nation.n_nationkey, "left")
        .select(
            F.col("s_name").alias("name"),
            F.col("s_acctbal").alias("price"),
            F.col("n_name").alias("state"),
            X.bucket("s_acctbal", [(5000, "urban"), (1000, "suburban")], "rural").alias("area_type"),
        )
        .na.drop(subset=["price", "state"])
        .withColumn("country_flag", F.lit("S"))
    )
    key_cols = ["name", "price", "state", "area_type", "country_flag"]
    stat_rows = (
        first.select(F.lit("lot").alias("_stat"), F.lit(None).cast("string").alias("state"), F.col("lot").alias("_x"))
        .unionByName(first.select(F.lit("price").alias("_stat"), "state", F.col("price").alias("_x")))
        .unionByName(second.select(F.lit("price").alias("_stat"), "state", F.col("price").alias("_x")))
        .withColumn("state", F.coalesce("state", F.lit("")))
    )
    # one row per state, plus lot: staged once, broadcast behind a row count
    meds = stage_bounded(group_quantiles(stat_rows, ["_stat", "state"], "_x", out="_m"), "state_medians")
    lot_value = meds.where(F.col("_stat") == "lot").select("_m").scalar()
    state_med = meds.where(F.col("_stat") == "price").select("state", F.col("_m").alias("state_median"))
    combined = first.select(*key_cols, "lot").unionByName(second.select(*key_cols).withColumn("lot", lot_value))
    flagged = combined.join(state_med, "state", "left").withColumn(
        "above_market", X.threshold_flag("price", F.col("state_median"), ">")
    )
    # labels do not depend on the flag: fit the dictionary on the union (cheap
    # upstream) and apply it to the flagged rows
    fill = {"area_type": "suburban", "state": "Unknown"}
    dictionary = fit_labels(combined, ["area_type", "state"], fill)
    encoded = apply_labels(flagged, dictionary, {"area_type": "area_enc", "state": "state_enc"}, fill)
    return encoded.select(
        "name", "country_flag", "state", "price", F.round("lot", 6).alias("lot"), "area_type",
        F.round("state_median", 4).alias("state_median"), "above_market", "area_enc", "state_enc",
    )


def market_position_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: per state, rows, median price and above-median rate."""
    rows = market_position(spark, sf_dir)
    return (
        rows.groupBy("state")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(F.when(F.col("country_flag") == "C", 1).otherwise(0)).cast("long").alias("n_first"),
            F.max("state_median").alias("state_median"),
            F.round(F.avg(F.col("above_market").cast("double")) * 100.0, 4).alias("above_pct"),
        )
        .orderBy("state")
    )


def market_position_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one source; filter, clip, drop nulls, state median on all rows,
    and encoding of every row.  (A sample belongs to a classifier's fit:
    ``exact_sample`` on this table.)"""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    listings = stage(
        orders.where(X.between_exclusive("o_totalprice", 10000, 450000))
        .join(cust, orders.o_custkey == cust.c_custkey, "left")
        .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left")
        .select(
            "o_orderkey",
            F.col("o_totalprice").alias("price"),
            F.col("n_name").alias("state"),
            "o_orderpriority",
            X.clip(F.col("o_totalprice") / F.lit(100000.0), 0.0, 4.0).alias("lot"),
        )
        .na.drop(subset=["price", "state"]),
        "listings",  # narrow; read by the median, the dictionary and the output
    )
    flagged = group_stat_flag(listings, ["state"], "price", out="above_market", stat_col="state_median")
    encoded, _ = encode(flagged, {"state": "state_enc", "o_orderpriority": "priority_enc"}, fill={"state": "Unknown"})
    return encoded.select(
        "o_orderkey", "state", "price", "lot", "above_market", "state_enc", "priority_enc"
    )


# --------------------------------------------------------------------------
# churn (two-level aggregation + left join + encoding)
# --------------------------------------------------------------------------
def churn_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """per-customer activity means/sums/counts and an ever-churned flag,
    left-joined with customer attributes, label-encoded, nulls -> 0.

    lineitem is pre-aggregated per order before the join (the join then
    moves one row per order), and the per-customer aggregate is algebraic
    with a map-side combine, so a very active customer is not a hot task."""
    li = _t(spark, sf_dir, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("qty"),
        F.avg("l_discount").alias("disc"),
    )
    orders = _t(spark, sf_dir, "orders")
    monthly = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    # pandas groupby drops null keys
    agg = monthly.where(F.col("o_custkey").isNotNull()).groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.avg("n_lines").alias("avg_calls"),
        F.avg("qty").alias("avg_views"),
        F.avg("disc").alias("avg_discount"),
        F.avg("o_totalprice").alias("avg_revenue"),
        F.coalesce(F.sum("n_lines"), F.lit(0)).cast("long").alias("total_deals"),
        F.count("o_orderkey").alias("months_active"),
        F.max(F.col("o_orderstatus") == F.lit("F")).alias("churned_b"),
    )
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    df = agg.join(cust, agg.customer_id == cust.c_custkey, "left").drop("c_custkey")
    df = df.withColumn("churned", X.boolish("churned_b"))
    df, _ = encode(df, {"c_mktsegment": "segment_enc"}, fill={"c_mktsegment": "End-User"})
    feats = ["avg_calls", "avg_views", "avg_discount", "avg_revenue", "c_acctbal"]
    out = df.select(
        "customer_id",
        "churned",
        "segment_enc",
        X.fill_default("c_nationkey", 0).alias("nation"),
        *[F.round(X.fill_default(c, 0.0), 6).alias(c) for c in feats],
        "total_deals",
        "months_active",
    )
    return out


# --------------------------------------------------------------------------
# content (membership target + encodings)
# --------------------------------------------------------------------------
def content_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """target = bucket in {top two}; categorical codes; nulls -> 0."""
    o = _t(spark, sf_dir, "orders")
    df = o.select(
        "o_orderkey",
        X.isin_flag("o_orderpriority", ["1-URGENT", "2-HIGH"]).alias("target"),
        "o_orderstatus",
        X.weekday_or("o_orderdate").alias("order_dow"),
        F.month("o_orderdate").alias("order_month"),
        "o_totalprice",
    )
    df, _ = encode(df, {"o_orderstatus": "status_enc"}, fill={"o_orderstatus": "O"})
    return df.select(
        "o_orderkey", "target", X.fill_default("status_enc", 0).alias("status_enc"), "order_dow", "order_month",
        X.fill_default("o_totalprice", 0.0).alias("o_totalprice"),
    )


# --------------------------------------------------------------------------
# listing sold (left join, coercion, boolean maps, median imputation)
# --------------------------------------------------------------------------
def listing_sold_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lines left-joined to parts; text flags mapped to 0/1, numeric
    text coerced, categoricals encoded, every feature median-imputed."""
    li = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"
    )
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    df = li.join(part, li.l_partkey == part.p_partkey, "left")
    df = df.select(
        "l_orderkey",
        "l_linenumber",
        X.boolish(F.when(F.col("l_linestatus") == "F", "True").otherwise("False")).alias("sold"),
        X.to_number(F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2))).alias("brand_no"),
        X.to_number(F.col("p_size")).alias("p_size"),
        X.to_number(F.col("p_retailprice")).alias("p_retailprice"),
        X.to_number(F.col("l_quantity")).alias("l_quantity"),
        X.to_number(F.col("l_extendedprice")).alias("l_extendedprice"),
        X.boolish(F.col("p_size") > 25, unknown_as_zero=True).alias("big_part"),
        "p_type",
        "l_returnflag",
    )
    df = stage(df, "listing_base")  # read by the dictionary, null-count and output passes
    df, _ = encode(df, {"p_type": "type_enc", "l_returnflag": "flag_enc"}, fill={"p_type": "STANDARD", "l_returnflag": "N"})
    feats = ["type_enc", "flag_enc", "brand_no", "p_size", "p_retailprice", "l_quantity", "l_extendedprice", "big_part"]
    df = impute_median(df, feats)
    return df.select("l_orderkey", "l_linenumber", "sold", *feats)


# --------------------------------------------------------------------------
# ad conversion (global median target, coercion, imputation)
# --------------------------------------------------------------------------
def ad_conversion_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """target = value > median(value); codes; coerced numerics; medians."""
    ev = _t(spark, sf_dir, "events")
    df = median_flag(ev, "value", out="target", stat_col="value_median")
    df = df.select(
        "event_id",
        "target",
        "event_type",
        X.hour_or("ts").alias("hour"),
        X.weekday_or("ts").alias("dow"),
        X.to_number(F.regexp_extract("props", r"(-?\d+)", 1)).alias("props_k"),
        F.col("user_id").cast("double").alias("user_id"),
        "value",
    )
    df, _ = encode(df, {"event_type": "type_enc"}, fill={"event_type": "view"})
    feats = ["type_enc", "hour", "dow", "props_k", "user_id", "value"]
    df = impute_median(df, feats)
    return df.select("event_id", "target", *feats)


# --------------------------------------------------------------------------
# sale vs ask (inclusive range filter, threshold target)
# --------------------------------------------------------------------------
def sale_vs_ask_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ratio kept within [0.5, 2.0]; target = ratio >= 1.0."""
    li = _t(spark, sf_dir, "lineitem")
    df = li.select(
        "l_orderkey",
        "l_linenumber",
        X.ratio("l_extendedprice", F.col("l_quantity") * F.lit(1000.0)).alias("ratio"),
        "l_returnflag",
        "l_linestatus",
        "l_quantity",
    ).where(X.between_inclusive("ratio", 0.5, 2.0))
    df = df.withColumn("target", X.threshold_flag("ratio", 1.0, ">="))
    df, _ = encode(df, {"l_returnflag": "type_enc", "l_linestatus": "sub_type_enc"}, fill={"l_returnflag": "N", "l_linestatus": ""})
    feats = ["type_enc", "sub_type_enc", "l_quantity"]
    df = impute_median(df, feats)
    return df.select("l_orderkey", "l_linenumber", "ratio", "target", *feats)


# --------------------------------------------------------------------------
# F8: video engagement (text/time expressions, median target, lookups)
# --------------------------------------------------------------------------
def category_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(CATEGORY_NAMES.items()), "category_id int, category_name string")


def video_engagement_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: documents as posts (views = characters, likes = words, comments
    = lines), a publish time parsed from text with coercion, category codes
    encoded as strings (so "10" < "2") and named through a lookup, target =
    like rate above its median."""
    docs = _t(spark, sf_dir, "documents").where(X.positive("n_chars"))
    ev = _t(spark, sf_dir, "events").select("event_id", "ts")
    df = docs.join(ev, docs.doc_id == ev.event_id, "left").select(
        "doc_id",
        F.col("lang").alias("country"),
        F.col("source").alias("title"),
        F.col("n_chars").alias("views"),
        X.word_count("text").alias("likes"),
        X.line_count("text").alias("comments"),
        X.token_count("text", sep=".").alias("tag_count"),
        X.parse_ts(F.col("ts").cast("string")).alias("publish_time"),
        (F.col("n_chars") % F.lit(30)).cast("int").alias("category_id"),
    )
    # whole texts are scanned once: the statistics below read this table
    df = stage(df, "post_features")
    df = df.select(
        "doc_id",
        "country",
        "category_id",
        X.ratio("likes", "views").alias("like_rate"),
        X.ratio("comments", "views").alias("comment_rate"),
        X.log1p("views").alias("log_views"),
        X.text_length("title").alias("title_length"),
        "tag_count",
        X.hour_or("publish_time", 12).alias("publish_hour"),
        X.weekday_or("publish_time", 0).alias("publish_dow"),
    )
    df = median_flag(df, "like_rate", out="target", stat_col="like_rate_median")
    df = X.lookup(df, "category_id", category_dim(spark), "category_id", "category_name", "category", CATEGORY_FALLBACK)
    df = df.withColumn("category_code", F.col("category_id").cast("string"))
    df, _ = encode(df, {"category_code": "cat_enc", "country": "country_enc"}, fill={"category_code": "24"})
    feats = ["cat_enc", "country_enc", "title_length", "tag_count", "publish_hour", "publish_dow", "log_views", "comment_rate"]
    df = impute_median(df, feats)
    return df.select(
        "doc_id", "country", "category",
        *[F.round(c, 8).alias(c) if c in ("log_views", "comment_rate") else c for c in feats],
        F.round("like_rate", 8).alias("like_rate"), "target",
    )


# --------------------------------------------------------------------------
# generic ML-ready table
# --------------------------------------------------------------------------
def ml_ready_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    labels = _t(spark, sf_dir, "labels")
    docs = _t(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return {
        "labeled_docs": labels.join(docs, "doc_id", "left"),
        "nation": _t(spark, sf_dir, "nation"),
        "region": _t(spark, sf_dir, "region"),
    }


def generic_ml_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.operators.clean import ml_ready

    df, _ = ml_ready(ml_ready_tables(spark, sf_dir))
    return df


def generic_ml_ready_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9 over all tables of the catalog, every column: all are cleaned, and the
    largest one is encoded."""
    from lodestar.operators.clean import ml_ready
    from lodestar.sources.io import TABLES

    df, _ = ml_ready({name: _t(spark, sf_dir, name) for name in TABLES})
    return df
