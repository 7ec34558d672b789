import math

from pyspark.sql import functions as F

from lodestar.functions import exprs as X


def _one(spark, expr, ddl, rows):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(expr).collect()]


def test_clip_keeps_null_and_bounds(spark):
    got = _one(spark, X.clip("v", 0, 50), "v double", [(None,), (-3.0,), (70.0,), (5.0,)])
    assert got == [None, 0.0, 50.0, 5.0]


def test_filters_treat_null_as_false(spark):
    rows = [(None,), (5.0,), (20.0,)]
    assert _one(spark, X.between_exclusive("v", 1, 10), "v double", rows) == [False, True, False]
    assert _one(spark, X.between_inclusive("v", 5, 20), "v double", rows) == [False, True, True]
    assert _one(spark, X.threshold_flag("v", 10.0, ">="), "v double", rows) == [0, 0, 1]


def test_nan_is_missing_on_either_side(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(nan,), (None,), (inf,), (-inf,), (0.0,), (3.0,)]
    assert _one(spark, X.between_exclusive("v", 1, 10), "v double", rows) == [False, False, False, False, False, True]
    assert _one(spark, X.between_inclusive("v", 0, inf), "v double", rows) == [False, False, True, False, True, True]
    assert _one(spark, X.positive("v"), "v double", rows) == [False, False, True, False, False, True]
    assert _one(spark, X.threshold_flag("v", 3, ">="), "v double", rows) == [0, 0, 1, 0, 0, 1]
    assert _one(spark, X.threshold_flag("v", 3, "<"), "v double", rows) == [0, 0, 0, 1, 1, 0]
    pairs = [(1.0, nan), (nan, 1.0), (nan, nan), (2.0, 1.0), (None, 1.0)]
    for op, want in ((">", [0, 0, 0, 1, 0]), ("<=", [0, 0, 0, 0, 0])):
        assert _one(spark, X.threshold_flag("v", F.col("t"), op), "v double, t double", pairs) == want
    assert _one(spark, X.clip("v", 0, 5), "v double", rows) == [None, None, 5.0, 0.0, 0.0, 3.0]
    assert _one(spark, X.to_number("v"), "v double", rows) == [None, None, inf, -inf, 0.0, 3.0]
    assert _one(spark, X.to_number("v"), "v int", [(3,), (None,)]) == [3.0, None]
    assert _one(spark, X.to_number("v"), "v string", [(" NaN",), ("1e3\t",), ("",)]) == [None, 1000.0, None]


def test_both_bounds_reach_the_scan(spark, scratch_dir):
    path = f"{scratch_dir}/bounds"
    spark.range(100).select(F.col("id").cast("double").alias("v"), "id").write.mode("overwrite").parquet(path)
    df = spark.read.parquet(path)

    def pushed(condition):
        plan = df.where(condition)._jdf.queryExecution().executedPlan().toString()
        return plan.split("PushedFilters: [")[1].split("]")[0]

    assert all(x in pushed(X.between_exclusive("v", 10, 50)) for x in ("GreaterThan(v,10.0)", "LessThan(v,50.0)", "IsNotNull(v)"))
    assert all(x in pushed(X.between_inclusive("v", 10, 50)) for x in ("GreaterThanOrEqual(v,10.0)", "LessThanOrEqual(v,50.0)"))
    assert "GreaterThan(id,0)" in pushed(X.positive("id"))


def test_bucket(spark):
    got = _one(spark, X.bucket("p", [(500000, "urban"), (100000, "suburban")], "rural"), "p double",
               [(None,), (99999.0,), (100000.0,), (600000.0,)])
    assert got == ["rural", "rural", "suburban", "urban"]


def test_token_count_semantics(spark):
    rows = [(None,), ("",), ("[none]",), ("a|b|c",), ("a||",), ("x",)]
    assert _one(spark, X.token_count("t"), "t string", rows) == [0, 0, 0, 3, 3, 1]


def test_word_and_line_counts(spark):
    rows = [("one two  three\nfour",), ("",), (None,)]
    assert _one(spark, X.word_count("t"), "t string", rows) == [4, 0, 0]
    assert _one(spark, X.line_count("t"), "t string", rows)[:2] == [2, 1]


def test_time_features_monday_zero_and_defaults(spark):
    rows = [("2024-01-01 13:05:00",), ("garbage",), (None,)]  # 2024-01-01 was a Monday
    df = spark.createDataFrame(rows, "s string").select(X.parse_ts("s").alias("t"))
    got = df.select(X.hour_or("t", 12), X.weekday_or("t", 0)).collect()
    assert [tuple(r) for r in got] == [(13, 0), (12, 0), (12, 0)]


def test_ratio_and_log(spark):
    got = spark.createDataFrame([(3, 0), (3, 6)], "a int, b int").select(X.ratio("a", "b"), X.log1p("b")).collect()
    assert got[0][0] is None and got[1][0] == 0.5 and math.isclose(got[1][1], math.log1p(6))


def test_boolish_and_coercion(spark):
    # the mapping knows True / False as values and as exactly spelled text
    rows = [("True",), ("False",), ("false",), (" True",), ("maybe",), (None,)]
    assert _one(spark, X.boolish("s"), "s string", rows) == [1, 0, None, None, None, None]
    assert _one(spark, X.boolish("s"), "s boolean", [(True,), (False,), (None,)]) == [1, 0, None]
    assert _one(spark, X.boolish("s", unknown_as_zero=True), "s string", rows) == [1, 0, 0, 0, 0, 0]
    assert _one(spark, X.to_number("s"), "s string", [(" 12.5 ",), ("x",), (None,)]) == [12.5, None, None]


def test_isin_and_display(spark):
    rows = [("viral",), ("low",), (None,)]
    assert _one(spark, X.isin_flag("b", ["viral", "high"]), "b string", rows) == [1, 0, 0]
    assert _one(spark, X.display_label("p", {0: "No Churn", 1: "Churn"}), "p int", [(0,), (1,)]) == ["No Churn", "Churn"]


def test_lookup_fallback(spark):
    dim = spark.createDataFrame([(10, "Music")], "id int, name string")
    df = spark.createDataFrame([(10,), (3,)], "c int")
    got = [r.label for r in X.lookup(df, "c", dim, "id", "name", "label", "Category %s").orderBy("c").collect()]
    assert got == ["Category 3", "Music"]
