"""The feature tables on their own columns, against pandas on small frames."""

import math

import numpy as np
import pandas as pd
import pytest

from lodestar.plans import tasks as T

SIZES = {"CHURN": 16, "CONTENT": 10, "LISTING": 14, "AD": 11, "SALE": 13, "MARKET": 6, "MARKET_UNION": 6, "VIDEO": 8}


def codes(s, default):
    filled = s.fillna(default).astype(str)
    return filled.map({v: i for i, v in enumerate(sorted(filled.unique()))})


def same(got, want, keys):
    got, want = got.sort_values(keys).reset_index(drop=True), want.sort_values(keys).reset_index(drop=True)
    assert list(got.columns) == list(want.columns)
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=1e-12)


def nothing(v):
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else v


def frame(spark, pdf, schema):
    return spark.createDataFrame([tuple(nothing(v) for v in r) for r in pdf.astype(object).itertuples(index=False)], schema)


@pytest.mark.parametrize("name", SIZES)
def test_feature_counts(name):
    spec = getattr(T, name)
    assert len(spec.features) == SIZES[name] == len(set(spec.features))


def test_churn(spark):
    rng = np.random.default_rng(0)
    n = 120
    monthly = pd.DataFrame({"customer_id": rng.integers(0, 20, n).astype(float), "month": rng.integers(1, 13, n).astype(float)})
    for c in ("calls", "views", "visits", "sessions", "avg_session_min", "engagement_score", "churn_risk", "revenue", "deals"):
        monthly[c] = np.where(rng.random(n) < 0.2, np.nan, rng.integers(0, 50, n))
    monthly["churned"] = rng.random(n) < 0.1
    monthly.loc[rng.random(n) < 0.1, ["customer_id", "month"]] = np.nan
    monthly.loc[monthly.customer_id == 3, "deals"] = np.nan
    customers = pd.DataFrame({"customer_id": np.arange(15.0), "segment": ["a", None, "b"] * 5, "acquisition_channel": ["x", "y", None] * 5,
                              "income_band": [None, "Low", "High"] * 5, "age": [30.0, np.nan, 50.0] * 5, "household_size": 2.0, "propensity_score": np.linspace(0, 1, 15)})
    means = {"avg_calls": "calls", "avg_views": "views", "avg_visits": "visits", "avg_sessions": "sessions", "avg_session_min": "avg_session_min",
             "avg_engagement": "engagement_score", "avg_churn_risk": "churn_risk", "avg_revenue": "revenue"}
    want = monthly.groupby("customer_id").agg(**{k: (v, "mean") for k, v in means.items()}, total_deals=("deals", "sum"), months_active=("month", "count"),
                                              churned=("churned", "max")).reset_index()
    want = want.merge(customers, on="customer_id", how="left")
    want["churned"] = want.churned.map({True: 1, False: 0})
    for c, (out, default) in T.CHURN.codes.items():
        want[out] = codes(want[c], default)
    want = want[["customer_id", *T.CHURN.features, "churned"]].fillna(0)
    kinds = ", ".join(f"{c} {'boolean' if c == 'churned' else 'double'}" for c in monthly.columns)
    got = T.churn_task(
        frame(spark, monthly, kinds), frame(spark, customers, "customer_id double, segment string, acquisition_channel string, income_band string, age double, household_size double, propensity_score double")
    )
    same(got.toPandas(), want, ["customer_id"])


def test_listing(spark):
    listings = pd.DataFrame({"listing": range(8), "property_id": [1.0, 2, 3, np.nan, 9, 1, 2, 3], "listing_channel": ["Open", None, "Agent", "Open", "x", None, "Agent", "Open"],
                             "listed_price": ["100", " 200 ", "bad", None, "400", "nan", "600", "1e3"], "sold_flag": ["True", "False", "true", None, "True", "False", "False", "True"]})
    properties = pd.DataFrame({"property_id": [1.0, 2, 3], "property_type": ["House", None, "Flat"], "city": ["B", "A", None], "size_sqm": ["50", "x", "70"],
                               "bedrooms": ["1", "2", None], "bathrooms": ["1"] * 3, "year_built": ["1990", "2000", "2010"], "location_score": ["7.5", "8.5", ""],
                               "amenities_count": ["3", "4", "5"], "list_price": ["10", "20", "30"], "has_parking": ["True", "False", "yes"],
                               "near_transit": ["True", None, "False"], "near_school": ["False", "True", "True"]})
    want = listings.merge(properties, on="property_id", how="left")
    want["sold"] = want.sold_flag.map({"True": 1, "False": 0})
    for c, (out, default) in T.LISTING.codes.items():
        want[out] = codes(want[c], default)
    for c in T.LISTING.numbers:
        want[c] = pd.to_numeric(want[c], errors="coerce")
    for c in T.LISTING.flags:
        want[c] = want[c].map({"True": 1, "False": 0}).fillna(0)
    feats = list(T.LISTING.features)
    want[feats] = want[feats].fillna(want[feats].median())
    strings = lambda cols: ", ".join(f"{c} string" for c in cols)
    got = T.listing_task(
        frame(spark, listings, "listing long, property_id double, " + strings(listings.columns[2:])),
        frame(spark, properties, "property_id double, " + strings(properties.columns[1:])), ["listing"],
    )
    same(got.toPandas(), want[["listing", *feats, "sold"]], ["listing"])


def places(n, seed):
    rng = np.random.default_rng(seed)
    hole = lambda v: np.where(rng.random(n) < 0.05, np.nan, v)
    return pd.DataFrame({"id": np.arange(n), "price": hole(rng.integers(5_000, 6_000_000, n)), "bed": hole(rng.integers(0, 18, n)), "bath": hole(rng.integers(0, 18, n)),
                         "acre_lot": hole(rng.integers(-5, 80, n)), "house_size": hole(rng.integers(50, 25_000, n)), "state": rng.choice(["s1", "s2", "s3", None], n),
                         "area_type": rng.choice(["urban", "rural", None], n)})


def clean(us):
    us = us[(us.price > 10_000) & (us.price < 5_000_000) & us.bed.between(1, 15) & us.bath.between(1, 15) & (us.house_size > 100) & (us.house_size < 20_000)].copy()
    us["acre_lot"] = us.acre_lot.clip(0, 50)
    return us.dropna(subset=["price", "bed", "bath", "house_size", "state", "area_type"])


def finished(df, keep):
    df = df.copy()
    df["above_market"] = (df.price > df.state.map(df.groupby("state").price.median())).astype(int)
    df["area_enc"], df["state_enc"] = codes(df.area_type, "suburban"), codes(df.state, "Unknown")
    feats = list(T.MARKET.features)
    df[feats] = df[feats].fillna(df[feats].median())
    return df[[*keep, *feats, "above_market"]]


US = "id long, price double, bed double, bath double, acre_lot double, house_size double, state string, area_type string"


def test_market(spark):
    us = places(300, 1)
    same(T.market_task(frame(spark, us, US), ["id"]).toPandas(), finished(clean(us), ["id"]), ["id"])


def test_market_union(spark):
    us, ca = places(200, 2), places(80, 3).rename(columns={"price": "Price", "bed": "Number_Beds", "bath": "Number_Baths", "state": "Province"})
    ca["Population"] = np.random.default_rng(4).choice([600_000.0, 100_000.0, 5.0, np.nan], len(ca))
    ca = ca[["id", "Price", "Number_Beds", "Number_Baths", "Province", "Population"]]
    first = clean(us).assign(country_flag="US")
    second = ca.rename(columns=T.SECOND_NAMES)
    second = second[(second.price > 10_000) & (second.price < 10_000_000) & second.bed.between(0, 15) & second.bath.between(0, 15)].dropna(subset=["price", "bed", "bath", "state"])
    second["area_type"] = second.Population.apply(lambda p: "urban" if p >= 500_000 else "suburban" if p >= 100_000 else "rural")
    second["house_size"], second["acre_lot"], second["country_flag"] = first.house_size.median(), first.acre_lot.median(), "CA"
    both = pd.concat([first, second[first.columns]], ignore_index=True)
    got = T.market_union_task(frame(spark, us, US), frame(spark, ca, "id long, Price double, Number_Beds double, Number_Baths double, Province string, Population double"), ["id"])
    same(got.toPandas(), finished(both, ["id", "country_flag"]), ["id", "country_flag"])


def test_video(spark):
    v = pd.DataFrame({"id": range(8), "country": ["CA", "US"] * 4, "views": [0, 10, 100, 1000, 50, 7, 300, 20], "likes": [1, 5, 20, 10, None, 3, 300, 2],
                      "comments": [0, 1, 2, 3, 4, 5, None, 7], "title": ["a", None, "ccc", "", "ée", "x y", "t", "q"], "tags": ["a|b", None, "[none]", "", "x", "a||b", "p|q|r", "|"],
                      "publish_time": ["2026-01-05T10:00:00Z", "bad", None, "2026-01-04 23:30:00", "2026-01-10T00:00:00Z", "", "2026-03-01", "2026-01-05T10:00:00Z"],
                      "category_id": [1, 10, 2, None, 24, 10, 1, 2]})
    want = v[v.views > 0].copy()
    like_rate, want["comment_rate"], want["log_views"] = want.likes / want.views, want.comments / want.views, np.log1p(want.views)
    want["title_length"] = want.title.fillna("").apply(len)
    want["tag_count"] = want.tags.fillna("").apply(lambda t: len(t.split("|")) if t and t != "[none]" else 0)
    at = pd.to_datetime(want.publish_time, errors="coerce", utc=True, format="mixed")
    want["publish_hour"], want["publish_dow"] = at.dt.hour.fillna(12).astype(int), at.dt.dayofweek.fillna(0).astype(int)
    want["target"] = (like_rate > like_rate.median()).astype(int)
    want["cat_enc"], want["country_enc"] = codes(want.category_id.fillna(24).astype(int).astype(str), "24"), codes(want.country, "")
    feats = list(T.VIDEO.features)
    want[feats] = want[feats].fillna(want[feats].median())
    kinds = "id long, country string, views long, likes double, comments double, title string, tags string, publish_time string, category_id double"
    got = T.video_task(frame(spark, v, kinds), ["id"]).toPandas()
    same(got, want[["id", *feats, "target"]], ["id"])


def test_empty_inputs(spark):
    assert T.market_task(frame(spark, places(0, 1), US), ["id"]).count() == 0
    assert T.feature_table(frame(spark, places(0, 1), US), T.MARKET).columns == [*T.MARKET.features, "above_market"]
