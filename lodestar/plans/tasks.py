"""The feature tables F1-F8 on their own columns (schemas in FIXTURES.md).

A task is a ``FeatureSpec``: which rows stay, what is clipped, coerced, mapped
and encoded, how the target is made and how holes are filled.  ``feature_table``
compiles it to one plan; joins, unions and aggregates come before it, as plain
DataFrame operations.  Every task is ``DataFrame -> DataFrame``: (``keep``
columns, features in order, label).

``stand_ins`` maps the driver's tables onto those columns, in expressions that
Spark and other SQL engines read alike.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import exprs as X
from lodestar.operators.encode import encode
from lodestar.operators.group_stats import group_stat_flag, median_flag
from lodestar.operators.order_stats import column_medians_dict
from lodestar.operators.scale import impute_median
from lodestar.session import stage
from lodestar.sources.io import read_table


@dataclass(frozen=True)
class FeatureSpec:
    """``where``: (kind, column, bounds...) with the kinds exclusive, inclusive
    and positive.  ``target``: (isin, column, values), (true, column),
    (at_least, column, bound) or (above_median, column[, group column]).
    ``codes``: column -> (code column, value for null).  ``holes``: zero or
    median."""

    name: str
    features: tuple[str, ...]
    target: tuple
    label: str = "target"
    where: tuple = ()
    clip: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    complete: tuple[str, ...] = ()
    codes: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    numbers: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    holes: str = "median"


_FILTERS = {"exclusive": X.between_exclusive, "inclusive": X.between_inclusive, "positive": X.positive}


def selected_rows(rows: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Filters, clips and complete cases of the specification."""
    for kind, column, *bounds in spec.where:
        rows = rows.where(_FILTERS[kind](column, *bounds))
    rows = rows.withColumns({c: X.clip(c, lo, hi) for c, (lo, hi) in spec.clip.items()}) if spec.clip else rows
    return rows.na.drop(subset=list(spec.complete)) if spec.complete else rows


def with_target(rows: DataFrame, spec: FeatureSpec) -> DataFrame:
    kind, column, *more = spec.target
    if kind == "isin":
        return rows.withColumn(spec.label, X.isin_flag(column, more[0]))
    if kind == "true":
        return rows.withColumn(spec.label, X.boolish(column))
    if kind == "at_least":
        return rows.withColumn(spec.label, X.threshold_flag(column, more[0], ">="))
    if more:
        return group_stat_flag(rows, [more[0]], column, out=spec.label, stat_col="_median").drop("_median")
    return median_flag(rows, column, out=spec.label, stat_col="_median").drop("_median")


def feature_table(rows: DataFrame, spec: FeatureSpec, keep: Sequence[str] = ()) -> DataFrame:
    """The rows of a specification: ``keep``, its features and its label."""
    kind, column, *more = spec.target
    used = {*keep, *spec.features, *spec.codes, column, *more[:1]} if kind == "above_median" else {*keep, *spec.features, *spec.codes, column}
    rows = selected_rows(rows, spec)
    coerced = {c: X.to_number(c) for c in spec.numbers} | {c: X.boolish(c, unknown_as_zero=True) for c in spec.flags}
    rows = rows.withColumns(coerced) if coerced else rows
    # read by the target's statistic, the dictionaries and the medians
    rows = stage(rows.select(*[c for c in rows.columns if c in used]), f"task_{spec.name}")
    rows = with_target(rows, spec)
    if spec.codes:
        rows, _ = encode(rows, {c: out for c, (out, _) in spec.codes.items()}, fill={c: default for c, (_, default) in spec.codes.items()})
    if spec.holes == "zero":
        rows = rows.withColumns({c: X.fill_default(X.no_nan(c), 0) for c in spec.features})
    else:
        rows = impute_median(rows, list(spec.features))
    return rows.select(*keep, *[F.col(c).cast("double").alias(c) for c in spec.features], spec.label)


# ------------------------------------------------------------------ the tasks
# Fixed values that must match the reference: feature names and their order,
# bounds, and the value that stands for a missing label.
CHURN = FeatureSpec(
    "churn",
    ("propensity_score", "segment_enc", "acquisition_enc", "income_enc", "age", "household_size", "avg_calls", "avg_views", "avg_visits",
     "avg_sessions", "avg_session_min", "avg_engagement", "avg_churn_risk", "avg_revenue", "total_deals", "months_active"),
    ("true", "churned"), label="churned",
    codes={"segment": ("segment_enc", "End-User"), "acquisition_channel": ("acquisition_enc", "Organic"), "income_band": ("income_enc", "Mid")},
    holes="zero",
)
CONTENT = FeatureSpec(
    "content",
    ("account_type_enc", "media_type_enc", "content_category_enc", "traffic_source_enc", "follower_count", "has_call_to_action", "post_hour",
     "day_enc", "caption_length", "hashtags_count"),
    ("isin", "performance_bucket_label", ("viral", "high")),
    codes={"account_type": ("account_type_enc", "brand"), "media_type": ("media_type_enc", "post"),
           "content_category": ("content_category_enc", "Lifestyle"), "traffic_source": ("traffic_source_enc", "Home Feed"),
           "day_of_week": ("day_enc", "Monday")},
    holes="zero",
)
LISTING = FeatureSpec(
    "listing",
    ("prop_type_enc", "size_sqm", "bedrooms", "bathrooms", "year_built", "location_score", "amenities_count", "list_price", "has_parking",
     "near_transit", "near_school", "list_channel_enc", "city_enc", "listed_price"),
    ("true", "sold_flag"), label="sold",
    codes={"property_type": ("prop_type_enc", "Apartment"), "listing_channel": ("list_channel_enc", "Open"), "city": ("city_enc", "Unknown")},
    numbers=("size_sqm", "bedrooms", "bathrooms", "year_built", "location_score", "amenities_count", "list_price", "listed_price"),
    flags=("has_parking", "near_transit", "near_school"),
)
AD = FeatureSpec(
    "ad",
    ("goal_enc", "channel_enc", "loc_enc", "lang_enc", "seg_enc", "aud_enc", "Duration", "Acquisition_Cost", "Clicks", "Impressions",
     "Engagement_Score"),
    ("above_median", "Conversion_Rate"),
    codes={"Campaign_Goal": ("goal_enc", "Brand Awareness"), "Channel_Used": ("channel_enc", "Instagram"), "Location": ("loc_enc", "USA"),
           "Language": ("lang_enc", "English"), "Customer_Segment": ("seg_enc", "General"), "Target_Audience": ("aud_enc", "All")},
    numbers=("Duration", "Acquisition_Cost", "Clicks", "Impressions", "Engagement_Score"),
)
SALE = FeatureSpec(
    "sale",
    ("type_enc", "sub_type_enc", "listPrice", "sqft", "lot_sqft", "stories", "beds", "baths", "baths_full", "garage", "year_built",
     "price_per_sqft_sold", "property_age_at_sale"),
    ("at_least", "sold_to_list_ratio", 1.0),
    where=(("inclusive", "sold_to_list_ratio", 0.5, 2.0),),
    codes={"type": ("type_enc", "Single Family"), "sub_type": ("sub_type_enc", "")},
    numbers=("listPrice", "sqft", "lot_sqft", "stories", "beds", "baths", "baths_full", "garage", "year_built", "price_per_sqft_sold",
             "property_age_at_sale"),
)
_PLACES = ("bed", "bath", "acre_lot", "house_size", "area_enc", "state_enc")
_PLACE_CODES = {"area_type": ("area_enc", "suburban"), "state": ("state_enc", "Unknown")}
MARKET = FeatureSpec(
    "market",
    _PLACES, ("above_median", "price", "state"), label="above_market",
    where=(("exclusive", "price", 10_000, 5_000_000), ("inclusive", "bed", 1, 15), ("inclusive", "bath", 1, 15), ("exclusive", "house_size", 100, 20_000)),
    clip={"acre_lot": (0, 50)},
    complete=("price", "bed", "bath", "house_size", "state", "area_type"),
    codes=_PLACE_CODES,
)
MARKET_SECOND = FeatureSpec(
    "market_second", (), (), where=(("exclusive", "price", 10_000, 10_000_000), ("inclusive", "bed", 0, 15), ("inclusive", "bath", 0, 15)),
    complete=("price", "bed", "bath", "state"),
)
MARKET_UNION = FeatureSpec("market_union", _PLACES, ("above_median", "price", "state"), label="above_market", codes=_PLACE_CODES)
VIDEO = FeatureSpec(
    "video",
    ("cat_enc", "country_enc", "title_length", "tag_count", "publish_hour", "publish_dow", "log_views", "comment_rate"),
    ("above_median", "like_rate"),
    where=(("positive", "views"),),
    codes={"category": ("cat_enc", "24"), "country": ("country_enc", "")},
)
SECOND_NAMES = {"Number_Beds": "bed", "Number_Baths": "bath", "Province": "state", "Price": "price"}
AREAS = [(500_000, "urban"), (100_000, "suburban")]


def churn_task(monthly: DataFrame, customers: DataFrame) -> DataFrame:
    """means, sums and counts per customer (null customers dropped, as in a
    pandas group), with the customer's own columns."""
    means = {"calls": "avg_calls", "views": "avg_views", "visits": "avg_visits", "sessions": "avg_sessions", "avg_session_min": "avg_session_min",
             "engagement_score": "avg_engagement", "churn_risk": "avg_churn_risk", "revenue": "avg_revenue"}
    activity = monthly.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        *[F.avg(c).alias(out) for c, out in means.items()],
        F.coalesce(F.sum("deals"), F.lit(0)).alias("total_deals"),
        F.count("month").alias("months_active"),
        F.max("churned").alias("churned"),
    )
    own = customers.select("customer_id", "segment", "acquisition_channel", "income_band", "age", "household_size", "propensity_score")
    return feature_table(activity.join(own, "customer_id", "left"), CHURN, keep=["customer_id"])


def content_task(posts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """F2."""
    return feature_table(posts, CONTENT, keep)


def listing_task(listings: DataFrame, properties: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """the property of a listing; a null id meets a null id, as in pandas."""
    p = properties.withColumnRenamed("property_id", "_id")
    return feature_table(listings.join(p, F.col("property_id").eqNullSafe(F.col("_id")), "left").drop("_id"), LISTING, keep)


def ad_task(ads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """F4."""
    return feature_table(ads, AD, keep)


def sale_task(sales: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """F5."""
    return feature_table(sales, SALE, keep)


def market_task(listings: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """F6, on all rows (a sample belongs to a classifier's fit)."""
    return feature_table(listings, MARKET, keep)


def market_union_task(first: DataFrame, second: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """the second source harmonised (names, area from the population, house
    and lot size from the first source's medians), one union, and the median of
    each state after it."""
    columns = ["price", "bed", "bath", "acre_lot", "house_size", "state", "area_type"]
    first = stage(selected_rows(first, MARKET).select(*keep, *columns).withColumn("country_flag", F.lit("US")), "market_first")
    medians = column_medians_dict(first, ["house_size", "acre_lot"])
    second = selected_rows(second.withColumnsRenamed(SECOND_NAMES), MARKET_SECOND)
    second = second.withColumns(
        {"area_type": X.bucket("Population", AREAS, "rural"), **{c: F.lit(v).cast("double") for c, v in medians.items()}, "country_flag": F.lit("CA")}
    )
    both = first.unionByName(second.select(*first.columns))
    return feature_table(both, MARKET_UNION, [*keep, "country_flag"])


def video_task(videos: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """F8, on the tagged files of all countries (``country``)."""
    at = X.parse_ts("publish_time")
    rows = videos.withColumns(
        {
            "like_rate": X.ratio("likes", "views"), "comment_rate": X.ratio("comments", "views"), "log_views": X.log1p("views"),
            "title_length": X.text_length("title"), "tag_count": X.token_count("tags"), "publish_hour": X.hour_or(at, 12),
            "publish_dow": X.weekday_or(at, 0), "category": F.col("category_id").cast("int").cast("string"),
        }
    )
    return feature_table(rows, VIDEO, keep)


# ------------------------------------------------------------------ stand-ins
STAND_INS: dict[str, tuple[str, tuple[str, ...]]] = {
    "customer_monthly_metrics": ("orders", (
        "o_custkey as customer_id", "nullif(o_orderstatus, 'P') as month", "nullif(o_orderkey % 7, 0) as calls", "o_totalprice as views",
        "o_orderkey % 5 as visits", "o_orderkey % 11 as sessions", "nullif(o_orderkey % 13, 5) as avg_session_min", "o_orderkey % 3 as engagement_score",
        "o_orderkey % 17 as churn_risk", "o_totalprice * 0.5 as revenue", "nullif(o_orderkey % 4, 1) as deals", "o_orderstatus = 'F' as churned")),
    "customers": ("customer", (
        "c_custkey as customer_id", "nullif(c_mktsegment, 'BUILDING') as segment", "concat('channel ', c_nationkey % 4) as acquisition_channel",
        "case when c_custkey % 9 > 0 then concat('band ', c_custkey % 3) end as income_band", "nullif(c_custkey % 60, 7) + 18 as age",
        "c_nationkey % 6 as household_size", "c_acctbal as propensity_score")),
    "content_posts": ("orders", (
        "o_orderkey as post_id",
        "case o_orderpriority when '1-URGENT' then 'viral' when '2-HIGH' then 'high' when '3-MEDIUM' then 'medium' else 'low' end as performance_bucket_label",
        "nullif(o_orderstatus, 'P') as account_type", "concat('media ', o_orderkey % 4) as media_type",
        "case when o_custkey % 10 > 0 then concat('category ', o_custkey % 12) end as content_category", "concat('traffic ', o_custkey % 5) as traffic_source",
        "case when o_orderkey % 8 < 7 then concat('day ', o_orderkey % 8) end as day_of_week", "o_totalprice as follower_count",
        "nullif(o_orderkey % 2, 0) as has_call_to_action", "o_orderkey % 24 as post_hour", "nullif(o_custkey % 200, 3) as caption_length",
        "o_custkey % 30 as hashtags_count")),
    "listings": ("lineitem", (
        "l_orderkey as listing_id", "l_linenumber as listing_line", "l_partkey + case when l_linenumber = 7 then 100000000 else 0 end as property_id",
        "nullif(l_returnflag, 'N') as listing_channel", "case when l_suppkey % 10 > 0 then concat(' ', l_suppkey, ' ') else 'n/a' end as listed_price",
        "case when l_linestatus = 'F' then 'True' else 'False' end as sold_flag")),
    "properties": ("part", (
        "p_partkey as property_id", "p_type as property_type", "nullif(p_brand, 'Brand#11') as city",
        "case when p_size % 10 > 0 then concat('', p_size) else 'unknown' end as size_sqm", "concat('', p_partkey % 6) as bedrooms",
        "case when p_partkey % 4 > 0 then concat('', p_partkey % 4) end as bathrooms", "concat('', 1950 + p_partkey % 70) as year_built",
        "concat('', p_partkey % 100, '.5') as location_score", "concat('', p_partkey % 15) as amenities_count", "p_retailprice as list_price",
        "p_partkey % 2 = 0 as has_parking", "case p_partkey % 3 when 0 then 'True' when 1 then 'False' else 'maybe' end as near_transit",
        "case when p_partkey % 5 > 0 then p_partkey % 5 = 1 end as near_school")),
    "ad_campaigns": ("events", (
        "event_id", "nullif(event_type, 'view') as Campaign_Goal", "concat('channel ', user_id % 5) as Channel_Used",
        "concat('place ', user_id % 50) as Location", "case when user_id % 7 > 0 then concat('language ', user_id % 7) end as Language",
        "concat('segment ', event_id % 6) as Customer_Segment", "concat('audience ', event_id % 9) as Target_Audience",
        "concat(event_id % 60, case when event_id % 11 = 0 then ' Days' else '' end) as Duration", "concat('', user_id, '.25') as Acquisition_Cost",
        "nullif(user_id % 100, 50) as Clicks", "event_id % 1000 as Impressions", "case when event_id % 13 > 0 then concat('', event_id % 13) else 'nan' end as Engagement_Score",
        "value as Conversion_Rate")),
    "il_sales": ("lineitem", (
        "l_orderkey as sale_id", "l_linenumber as sale_line", "nullif(l_returnflag, 'R') as type", "nullif(l_linestatus, 'O') as sub_type",
        "concat('', l_suppkey * 1000) as listPrice", "case when l_partkey % 9 > 0 then concat('', 400 + l_partkey % 3000) else '' end as sqft",
        "concat('', l_orderkey % 9000) as lot_sqft", "concat('', 1 + l_orderkey % 3) as stories", "nullif(concat('', l_partkey % 7), '0') as beds",
        "concat('', l_partkey % 4) as baths", "concat('', l_partkey % 3) as baths_full", "nullif(concat('', l_suppkey % 4), '3') as garage",
        "concat('', 1900 + l_partkey % 120) as year_built", "l_discount * 1000 as price_per_sqft_sold", "concat('', l_orderkey % 90) as property_age_at_sale",
        "l_extendedprice / (l_quantity * 1000) as sold_to_list_ratio")),
    "us_listings": ("customer", (
        "c_custkey as place_id", "c_acctbal * 100 as price", "c_custkey % 18 as bed", "nullif(c_custkey % 7, 0) as bath", "(c_custkey % 700) / 10e0 - 5 as acre_lot",
        "nullif(c_custkey % 25, 0) * 1000 as house_size", "nullif(concat('state ', c_nationkey), 'state 3') as state", "nullif(lower(c_mktsegment), 'machinery') as area_type")),
    "ca_listings": ("supplier", (
        "s_suppkey as place_id", "s_acctbal * 150 as Price", "s_suppkey % 17 as Number_Beds", "s_suppkey % 5 as Number_Baths",
        "nullif(s_suppkey % 11, 4) * 80000 as Population", "concat('state ', s_nationkey + 5) as Province")),
    "trending_videos": ("documents", (
        "doc_id", "lang as country", "nullif(source, 'src3') as title", "n_chars - 600 as views", "doc_id % 997 as likes", "doc_id % 13 as comments",
        "case doc_id % 5 when 0 then '[none]' when 1 then '' when 2 then null else concat('a|b|', source) end as tags",
        "case when doc_id % 6 > 0 then concat('2026-0', 1 + doc_id % 9, '-1', doc_id % 10, ' 0', doc_id % 8, ':30:00') else 'soon' end as publish_time",
        "nullif(doc_id % 31, 30) as category_id")),
}


def stand_in(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table under the columns of a task's input."""
    table, columns = STAND_INS[name]
    return read_table(spark, sf_dir, table).selectExpr(*columns)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def task_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 features of every customer with orders."""
    out = churn_task(stand_in(spark, sf_dir, "customer_monthly_metrics"), stand_in(spark, sf_dir, "customers"))
    return _rounded(out, *[c for c in CHURN.features if c.startswith("avg_")])


def task_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10 features of every post."""
    return content_task(stand_in(spark, sf_dir, "content_posts"), ["post_id"])


def task_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """14 features of every listing."""
    return listing_task(stand_in(spark, sf_dir, "listings"), stand_in(spark, sf_dir, "properties"), ["listing_id", "listing_line"])


def task_ad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """11 features of every campaign."""
    return ad_task(stand_in(spark, sf_dir, "ad_campaigns"), ["event_id"])


def task_sale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """13 features of every sale within the bounds."""
    return sale_task(stand_in(spark, sf_dir, "il_sales"), ["sale_id", "sale_line"])


def task_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """6 features of every listing within the bounds."""
    return market_task(stand_in(spark, sf_dir, "us_listings"), ["place_id"])


def task_market_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """6 features of the listings of both sources."""
    return market_union_task(stand_in(spark, sf_dir, "us_listings"), stand_in(spark, sf_dir, "ca_listings"), ["place_id"])


def task_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: 8 features of every video that was viewed."""
    return _rounded(video_task(stand_in(spark, sf_dir, "trending_videos"), ["doc_id"]), "log_views", "comment_rate")


TASK_QUERIES = {f.__name__: f for f in (task_churn, task_content, task_listing, task_ad, task_sale, task_market, task_market_union, task_video)}


# ----------------------------------------------------------------- SQL oracles
def _source(name: str) -> str:
    table, columns = STAND_INS[name]
    return f"select {', '.join(columns)} from {table}"


def _code(column: str, default: str) -> str:
    return f"dense_rank() over (order by coalesce(cast({column} as varchar), '{default}')) - 1"


def _number(column: str) -> str:
    return f"case when isnan(try_cast(trim(cast({column} as varchar)) as double)) then null else try_cast(trim(cast({column} as varchar)) as double) end"


def _flag(column: str) -> str:
    return f"case when cast({column} as varchar) in ('True', 'true') then 1 else 0 end"


def _spec_sql(source: str, spec: FeatureSpec, keep: Sequence[str], target: str, round_to: Sequence[str] = ()) -> str:
    """``source`` holds the filtered rows; ``target`` is the label's expression."""
    coded = {out: _code(c, default) for c, (out, default) in spec.codes.items()}
    made = {c: coded.get(c) or (_number(c) if c in spec.numbers else _flag(c) if c in spec.flags else c) for c in spec.features}
    hole = (lambda c: "0") if spec.holes == "zero" else (lambda c: f"median({c}) over ()")
    show = lambda c: f"round(cast(coalesce({c}, {hole(c)}) as double), 6)" if c in round_to else f"cast(coalesce({c}, {hole(c)}) as double)"
    return f"""
with source as ({source}),
made as (select {", ".join(keep)}, {", ".join(f"{e} as {c}" for c, e in made.items())}, cast({target} as integer) as {spec.label} from source)
select {", ".join(keep)}, {", ".join(f"{show(c)} as {c}" for c in spec.features)}, {spec.label} from made"""


_AVERAGES = ("calls", "views", "visits", "sessions")
_MARKET_ROWS = f"""select place_id, price, bed, bath, case when acre_lot is null then null else least(greatest(acre_lot, 0), 50) end as acre_lot, house_size, state, area_type
from ({_source("us_listings")}) where price > 10000 and price < 5000000 and bed between 1 and 15 and bath between 1 and 15
and house_size > 100 and house_size < 20000 and state is not null and area_type is not null"""

TASK_ORACLE_SQL = {
    "task_churn": _spec_sql(
        f"""select a.*, segment, acquisition_channel, income_band, age, household_size, propensity_score from (
  select customer_id, {", ".join(f"avg({c}) as avg_{c}" for c in _AVERAGES)}, avg(avg_session_min) as avg_session_min, avg(engagement_score) as avg_engagement,
         avg(churn_risk) as avg_churn_risk, avg(revenue) as avg_revenue, coalesce(sum(deals), 0) as total_deals, count(month) as months_active,
         bool_or(churned) as ever from ({_source("customer_monthly_metrics")}) where customer_id is not null group by customer_id) a
  left join ({_source("customers")}) c on a.customer_id = c.customer_id""",
        CHURN, ["customer_id"], "ever", [c for c in CHURN.features if c.startswith("avg_")],
    ),
    "task_content": _spec_sql(_source("content_posts"), CONTENT, ["post_id"], "performance_bucket_label in ('viral', 'high')"),
    "task_listing": _spec_sql(
        f"select l.*, p.* exclude (property_id) from ({_source('listings')}) l left join ({_source('properties')}) p on l.property_id = p.property_id",
        LISTING, ["listing_id", "listing_line"], "case sold_flag when 'True' then 1 when 'False' then 0 end",
    ),
    "task_ad": _spec_sql(_source("ad_campaigns"), AD, ["event_id"], "coalesce(Conversion_Rate > median(Conversion_Rate) over (), false)"),
    "task_sale": _spec_sql(
        f"select * from ({_source('il_sales')}) where sold_to_list_ratio between 0.5 and 2.0", SALE, ["sale_id", "sale_line"], "sold_to_list_ratio >= 1.0"
    ),
    "task_market": _spec_sql(_MARKET_ROWS, MARKET, ["place_id"], "price > median(price) over (partition by state)"),
    "task_market_union": _spec_sql(
        f"""with first as ({_MARKET_ROWS})
  select *, 'US' as country_flag from first
  union all
  select place_id, Price, Number_Beds, Number_Baths, (select median(acre_lot) from first), (select median(house_size) from first), Province,
         case when Population >= 500000 then 'urban' when Population >= 100000 then 'suburban' else 'rural' end, 'CA'
  from ({_source("ca_listings")}) where Price > 10000 and Price < 10000000 and Number_Beds between 0 and 15 and Number_Baths between 0 and 15 and Province is not null""",
        MARKET_UNION, ["place_id", "country_flag"], "price > median(price) over (partition by state)",
    ),
    "task_video": _spec_sql(
        f"""select doc_id, country, coalesce(cast(category_id as varchar), '24') as category, length(coalesce(title, '')) as title_length,
         case when tags is null or tags in ('', '[none]') then 0 else len(string_split(tags, '|')) end as tag_count,
         coalesce(hour(try_cast(publish_time as timestamp)), 12) as publish_hour, coalesce(isodow(try_cast(publish_time as timestamp)) - 1, 0) as publish_dow,
         ln(1 + views) as log_views, comments / views as comment_rate, likes / views as like_rate
  from ({_source("trending_videos")}) where views > 0""",
        VIDEO, ["doc_id"], "like_rate > median(like_rate) over ()", ["log_views", "comment_rate"],
    ),
}
