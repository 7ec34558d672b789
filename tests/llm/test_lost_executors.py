"""Results that hold when files are dealt to other tasks between two scans, as
after a lost executor."""

import pytest

from lodestar.llm.ann import op1_nn_descent
from lodestar.llm.mixing import mix_documents
from lodestar.llm.neardup import deduplicate, op3_weighted_minhash
from lodestar.llm.secrets import op4_secret_ownership

SF = "/root/testdata/sf0.01"


@pytest.fixture()
def dealt_anew(spark, tmp_path):
    """(folder with the tables in nine files, a function that changes how they are dealt)."""
    for name in ("documents", "embeddings"):
        spark.read.parquet(f"{SF}/{name}.parquet").repartition(9).write.parquet(f"{tmp_path}/{name}.parquet")
    keys = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")

    def deal(n):
        spark.conf.set(keys[0], n)
        spark.conf.set(keys[1], 1 if n > 9 else 1 << 30)

    yield str(tmp_path), deal
    for k in keys:
        spark.conf.unset(k)


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("work", [deduplicate, mix_documents])
def test_documents(spark, dealt_anew, work):
    folder, deal = dealt_anew
    deal(16)
    want = rows(work(spark.read.parquet(f"{folder}/documents.parquet")).select("doc_id", "text"))
    deal(2)
    late = work(spark.read.parquet(f"{folder}/documents.parquet")).select("doc_id", "text")
    deal(16)  # the result is read with more tasks than it was planned with
    got = rows(late)
    if work is mix_documents:
        assert got == want
    else:  # which copy stays may differ with the order of the files, how many may not
        assert len(got) == len(want) == len(set(got))


@pytest.mark.parametrize("query", [op3_weighted_minhash, op4_secret_ownership, op1_nn_descent])
def test_queries(spark, dealt_anew, query):
    folder, deal = dealt_anew
    deal(16)
    want = rows(query(spark, folder))
    deal(2)
    late = query(spark, folder)
    deal(16)
    assert rows(late) == want
