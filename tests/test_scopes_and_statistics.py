"""Staging scopes, distinct counts and correlations."""

import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestar.operators.clean import infer_target
from lodestar.operators.profile import corr_pairs, distinct_counts, two_valued
from lodestar.plans.features import market_position_summary
from lodestar.session import checkpoint_root, stage, staging


def test_a_scope_leaves_no_files(spark, scratch_dir):
    root = f"{checkpoint_root(spark)}/lodestar"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    with staging(spark) as path:
        market_position_summary(spark, "/root/testdata/sf0.001").write.mode("overwrite").parquet(f"{scratch_dir}/summary")
        assert os.listdir(path)
        with staging(spark) as inner:
            stage(spark.range(3), "x")
            assert len(os.listdir(inner)) == 1
        assert not os.path.exists(inner) and os.path.exists(path)
    assert set(os.listdir(root)) == before
    assert spark.read.parquet(f"{scratch_dir}/summary").count() == 24


def test_a_scope_ends_with_an_error(spark):
    with pytest.raises(RuntimeError), staging(spark) as path:
        stage(spark.range(3), "x")
        raise RuntimeError
    assert not os.path.exists(path)


def odd(spark):
    rows = [("a" * 50_000, 0.0, 1, None, True), ("b", -0.0, 2, None, False), ("b", float("nan"), 1, None, None), (None, None, 3, None, True), ("a" * 50_000, 1.0, 1, None, False)]
    return spark.createDataFrame(rows, "`Owner's text` string, `d.x` double, n int, hole string, flag boolean")


def test_distinct_counts(spark):
    got = {r["column"]: r["n_distinct"] for r in distinct_counts(odd(spark)).collect()}
    assert got == {"Owner's text": 2, "d.x": 3, "n": 3, "flag": 2}
    wide = spark.range(30_000).select((F.col("id") % 20_011).alias("x"), F.lit("t").alias("y"))
    assert {r["column"]: r["n_distinct"] for r in distinct_counts(wide).collect()} == {"x": 20_011, "y": 1}


def test_distinct_counts_move_no_texts(spark, scratch_dir):
    odd(spark).toDF("t", "d", "n", "h", "f").write.mode("overwrite").parquet(f"{scratch_dir}/odd")
    plan = distinct_counts(spark.read.parquet(f"{scratch_dir}/odd"))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("hashpartitioning(i#" in line for line in exchanges)


def test_two_valued_columns(spark):
    assert two_valued(odd(spark)) == ["Owner's text", "flag"]
    assert infer_target(odd(spark)) == "flag"
    assert infer_target(odd(spark).select("n", "hole")) == "hole"
    many = spark.range(500).select(*[F.concat(F.lit(f"v{i}-"), F.col("id") % 2).alias(f"c{i}") for i in range(120)], "id")
    assert two_valued(many) == [f"c{i}" for i in range(120)]  # whatever values share a register


def test_correlations_equal_pandas(spark):
    rng = np.random.default_rng(0)
    n, d = 500, 12
    x = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + 1e6
    x[rng.random((n, d)) < 0.1] = np.nan
    x[:, 3], x[:, 4], x[:-1, 5] = 7.25, np.nan, np.nan
    pdf = pd.DataFrame(x, columns=[f"c '{i}'" for i in range(d)])
    rows = [tuple(None if math.isnan(v) and i % 2 else float(v) for i, v in enumerate(r)) for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in pdf.columns)).repartition(5)
    want = pdf.corr()
    got = {(r["a"], r["b"]): r["r"] for r in corr_pairs(df, list(pdf.columns), digits=None).collect()}
    assert len(got) == d * (d - 1) // 2
    for (a, b), r in got.items():
        w = want.loc[a, b]
        assert (r is None) == math.isnan(w) and (r is None or r == pytest.approx(w, abs=1e-9)), (a, b)


def test_plan_of_correlations_grows_with_the_columns(spark):
    def size(d):
        df = spark.range(5).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(d)])
        return len(corr_pairs(df, df.columns)._jdf.queryExecution().optimizedPlan().toString())

    assert size(80) < 6 * size(20)


def test_correlations_of_nothing(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert [r["r"] for r in corr_pairs(df, ["a", "b"]).collect()] in ([], [None])
    assert corr_pairs(df, ["a"]).count() == 0
