"""Inputs that the driver's tables do not hold: hot values, NaN, odd names,
name collisions, failing files, pandas-style CSV."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestar.functions import exprs as X
from lodestar.operators.clean import clean_table
from lodestar.operators.encode import fit_labels
from lodestar.operators.order_stats import column_quantiles, exact_sample, group_quantiles
from lodestar.operators.profile import column_profile, corr_pairs
from lodestar.operators.scale import impute_median, null_columns
from lodestar.sources import io


def test_quantiles_with_a_hot_value(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": np.where(rng.random(20_000) < 0.8, "hot", "cold"), "v": np.where(rng.random(20_000) < 0.9, 5.0, rng.normal(size=20_000).round(2))})
    df = spark.createDataFrame(pdf)
    for q in (0.0, 0.25, 0.5, 0.93, 1.0):
        got = {r.g: r["quantile"] for r in group_quantiles(df, ["g"], "v", q=q).collect()}
        want = pdf.groupby("g").v.quantile(q)
        assert all(abs(got[k] - want[k]) < 1e-12 for k in want.index)
    # equal values are one row before anything is sorted
    plan = group_quantiles(df, ["g"], "v")._jdf.queryExecution().toString()
    assert "_rank" not in plan


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (3.0,), (60.0,)], "x double")
    one = lambda c: [r[0] for r in df.select(c).collect()]
    assert one(X.threshold_flag("x", 1.0)) == [0, 0, 1, 1]
    assert one(X.positive("x")) == [False, False, True, True]
    assert one(X.between_exclusive("x", 0, 50)) == [False, False, True, False]
    assert one(X.clip("x", 0.0, 50.0)) == [None, None, 3.0, 50.0]
    assert null_columns(df, ["x"]) == ["x"]
    assert [r.x for r in impute_median(df, ["x"]).collect()] == [31.5, 31.5, 3.0, 60.0]
    text = spark.createDataFrame([("nan",), (" 4\t",), ("x",), (None,)], "s string")
    assert [r[0] for r in text.select(X.to_number("s")).collect()] == [None, 4.0, None, None]


def test_column_names_with_quotes_and_dots(spark):
    df = spark.createDataFrame([(1.0, "a", 2.0), (None, "b", 4.0), (3.0, None, 9.0), (3.0, "b", 7.0)], ["Owner's x", "a.b", "c d"])
    prof = {r.column: r for r in column_profile(df).collect()}
    assert prof["Owner's x"].median == 3.0 and prof["a.b"]["mode"] == "b" and prof["c d"].non_null == 4
    assert corr_pairs(df, ["Owner's x", "c d"]).count() == 1
    assert {r.column: r["median"] for r in column_quantiles(df, ["Owner's x"]).collect()} == {"Owner's x": 3.0}
    out = clean_table(df)
    assert out.columns == ["Owner_s x", "a.b", "c d"] and out.where(F.col("`a.b`").isNull()).count() == 0


def test_table_name_collision_and_failed_file(spark, scratch_dir, tmp_path):
    stem = "x" * 50
    paths = {}
    for i, n in enumerate((3, 5)):
        p = tmp_path / f"{stem}{i}.csv"
        p.write_text("a\n" + "\n".join(str(k) for k in range(n)) + "\n")
        paths[str(i)] = f"file://{p}"
    paths["gone"] = f"file://{tmp_path}/gone.csv"
    reg = {r.source: r for r in io.load_tables(spark, paths, database="exactness").collect()}
    assert len({r.table for r in reg.values()}) == 3
    assert [spark.table(f"exactness.{reg[paths[k]].table}").count() for k in "01"] == [3, 5]
    assert reg[paths["gone"]].error and reg[paths["gone"]].rows is None


def test_csv_like_pandas(spark, tmp_path):
    p = tmp_path / "v.csv"
    p.write_text('id,title,views,ok,score\n1,"He said ""hi"", ok",10,True,1.5\n2,"two\nlines",NA,False,nan\n3,n/a,30,,2e3\n')
    got = io.read_csv(spark, f"file://{p}")
    assert dict(got.dtypes) == {"id": "bigint", "title": "string", "views": "bigint", "ok": "boolean", "score": "double"}
    assert [tuple(r) for r in got.orderBy("id").collect()] == [
        (1, 'He said "hi", ok', 10, True, 1.5), (2, "two\nlines", None, False, None), (3, None, 30, None, 2000.0),
    ]
    want = pd.read_csv(p)
    assert got.toPandas().sort_values("id").title.fillna("-").tolist() == want.title.fillna("-").tolist()


def test_tagged_csv_aligns_by_name(spark, tmp_path):
    (tmp_path / "AA_t.csv").write_text("id,title,views,likes\n1,x,40,5\n")
    (tmp_path / "BB_t.csv").write_text('id,views,likes,title\n2,41,6,"y, ""z"""\n')
    (tmp_path / "CC_t.csv").write_text("id,title\n3,w\n")
    got = io.read_tagged(spark, f"file://{tmp_path}/*_t.csv", fmt="csv")
    rows = sorted((r.tag, r.id, r.title, r.views, r.likes) for r in got.collect())
    assert rows == [("AA", 1, "x", 40, 5), ("BB", 2, 'y, "z"', 41, 6), ("CC", 3, "w", None, None)]


def test_labels_and_samples_have_one_path(spark):
    df = spark.range(1000).selectExpr("concat('k', id % 37) k", "id")
    codes = {r.label: r.code for r in fit_labels(df, ["k"]).collect()}
    assert codes == {k: i for i, k in enumerate(sorted({f"k{i}" for i in range(37)}))}
    a, b = (sorted(r.id for r in exact_sample(df.repartition(n), 100, key_cols=["id"]).collect()) for n in (3, 7))
    assert a == b and len(a) == 100


@pytest.mark.parametrize("value", ["café", "a "])
def test_strip_any_white_space(spark, value):
    df = X.trim_strings(spark.createDataFrame([(f"\t {value} \n",)], "`a.b` string"))
    assert df.first()[0] == value.strip()
