import sys

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents rows from (doc_id, text[, source[, lang]])."""

    def make(rows, extra=()):
        full = []
        for r in rows:
            doc_id, text, source, lang = (list(r) + ["s0", "en"][len(r) - 2 :] if len(r) < 4 else list(r))[:4]
            full.append((doc_id, text, lang, source, len(text) if text is not None else None, *[f"x{i}" for i in range(len(extra))]))
        schema = DOC_SCHEMA + "".join(f", {c} string" for c in extra)
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture()
def sf_of(spark, tmp_path):
    """A folder that holds the given tables, as a query's sf_dir."""

    def write(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
