import os

from lodestar.sources import io


def test_name_sanitizers():
    assert io.sanitize_name("Sale Price ($)") == "sale_price____"
    assert io.model_safe_name('a<b>[c]{d}|"e\'f\\g/h*i?j:k') == "a_b__c__d___e_f_g_h_i_j_k"
    assert io.safe_table_name("/x/y/My File-2024.csv") == "raw_my_file_2024"
    assert len(io.safe_table_name("/x/" + "a" * 80 + ".csv")) == len("raw_") + 50


def test_read_tagged_and_load_tables(spark, scratch_dir):
    d = os.path.join(scratch_dir, "trending")
    os.makedirs(d, exist_ok=True)
    for cc, n in (("US", 3), ("GB", 2)):
        with open(os.path.join(d, f"{cc}_Trending.csv"), "w") as fh:
            fh.write("views,title\n" + "".join(f"{i * 10},t{i}\n" for i in range(n)))
    df = io.read_tagged(spark, os.path.join(d, "*_Trending.csv"), fmt="csv", tag_col="country", inferSchema="true")
    counts = {r.country: r["count"] for r in df.groupBy("country").count().collect()}
    assert counts == {"US": 3, "GB": 2}
    reg = io.load_tables(spark, {"a": os.path.join(d, "US_Trending.csv")}, database="lodestar_test").collect()
    assert reg[0]["table"] == "raw_us_trending" and reg[0]["rows"] == 3


def test_select_candidates_matches_greedy(spark):
    rows = [("q1", "r1", 1), ("q1", "r2", 2), ("q1", "r3", 3), ("q2", "r1", 1), ("q2", "r3", 2), ("q2", "r4", 3), ("q3", "r2", 1)]
    df = spark.createDataFrame(rows, "q string, ref string, pos int")
    got = sorted((r.q, r.ref) for r in io.select_candidates(df, "q", "ref", "pos", 2, ["q1", "q2", "q3"]).collect())
    # greedy: q1 takes r1, r2; q2 skips r1, takes r3, r4; q3 finds r2 taken
    assert got == [("q1", "r1"), ("q1", "r2"), ("q2", "r3"), ("q2", "r4")]
