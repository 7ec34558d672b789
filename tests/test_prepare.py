from pyspark.sql import functions as F

from lodestar.operators.clean import binarize_target, clean_table, infer_target, ml_ready
from lodestar.operators.encode import decode, encode
from lodestar.operators.profile import column_profile, corr_pairs, modes
from lodestar.operators.scale import impute_median, min_max
from lodestar.operators.split import allocate, fold_column, stratified_split


def raw_any(spark):
    rows = [
        ("  a ", 1.0, None, 7, "x", "Yes", 9.0),
        ("b", None, 2.0, 7, "y", "No", None),
        ("b", 3.0, 1.0, 7, None, "No", None),
        ("b", 3.0, 1.0, 7, None, "No", None),  # duplicate of the row above
        ("c", 10.0, None, 7, "y", "Yes", None),
    ]
    return spark.createDataFrame(
        rows, "name string, amount double, sparse double, const int, cat string, Churned string, mostly_null double"
    )


def test_clean_table_semantics(spark):
    out = clean_table(raw_any(spark))
    cols = out.columns
    assert "mostly_null" not in cols  # 1 non-null < int(5 * 0.5)
    assert "sparse" in cols  # 3 non-null (counted before de-duplication)
    assert "const" not in cols  # sample std == 0
    pdf = out.toPandas()
    assert len(pdf) == 4  # one duplicate removed
    assert set(pdf["name"]) == {"a", "b", "c"}  # trimmed
    assert sorted(pdf["sparse"]) == [1.0, 1.5, 1.5, 2.0]  # median of the de-duplicated values
    assert sorted(pdf["cat"]) == ["x", "y", "y", "y"]  # mode fill
    assert sorted(pdf["amount"]) == [1.0, 3.0, 3.0, 10.0]


def test_infer_and_binarize_target(spark):
    df = clean_table(raw_any(spark))
    assert infer_target(df) == "Churned"
    b = binarize_target(df.withColumnRenamed("Churned", "churn"))
    assert sorted(set(r.churn for r in b.collect())) == [0, 1]


def test_labels_sort_as_strings_and_round_trip(spark):
    df = spark.createDataFrame([(1,), (10,), (2,), (15,), (2,)], "cat int")
    enc, d = encode(df, {"cat": "cat_enc"})
    pairs = sorted({(r.cat, r.cat_enc) for r in enc.collect()})
    assert pairs == [(1, 0), (2, 3), (10, 1), (15, 2)]
    back = decode(enc, d, "cat", "cat_enc", "cat_back")
    assert all(str(r.cat) == r.cat_back for r in back.collect())


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "s string")
    assert modes(df, ["s"]).first()["mode"] == "a"


def test_min_max_constant_is_zero_and_range(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (2.0, 5.0)], "a double, c double")
    out, _ = min_max(df, ["a", "c"])
    rows = out.collect()
    assert sorted(r.a for r in rows) == [0.0, 0.5, 1.0]
    assert all(r.c == 0.0 for r in rows)


def test_impute_median(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (10.0,)], "a double")
    assert sorted(r.a for r in impute_median(df, ["a"]).collect()) == [1.0, 3.0, 3.0, 10.0]


def test_stratified_split_exact_and_disjoint(spark):
    df = spark.range(0, 1000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    s = stratified_split(df, "y", ["id"], test_size=0.2, seed=7)
    counts = {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()}
    exp = allocate({0: 900, 1: 100}, 0.2)
    assert counts[(0, "test")] == exp[0] and counts[(1, "test")] == exp[1]
    assert s.select("id").distinct().count() == 1000
    again = stratified_split(df, "y", ["id"], test_size=0.2, seed=7)
    t1 = {r.id for r in s.where("split = 'test'").collect()}
    t2 = {r.id for r in again.where("split = 'test'").collect()}
    assert t1 == t2


def test_fold_column_balanced(spark):
    df = spark.range(0, 103).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    f = fold_column(df, "y", 5, key_cols=["id"])
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 2 and sum(sizes) == 103


def test_profile_and_corr(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a"), (2.0, 4.0, "a"), (3.0, 6.5, "b")], "x double, y double, s string")
    prof = {r.column: r for r in column_profile(df).collect()}
    assert prof["x"].median == 2.0 and prof["s"].mode == "a" and prof["s"].n_distinct == 2
    r = corr_pairs(df, ["x", "y"], digits=2).first()
    assert (r.a, r.b) == ("x", "y") and r.r == 1.0


def test_ml_ready_keeps_largest(spark):
    small = spark.createDataFrame([(1, "a")], "k int, s string")
    df, target = ml_ready({"small": small, "raw": raw_any(spark)})
    assert target == "Churned" and "churn" in df.columns
