import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import plain  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, score string, row string"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with odd texts, null and repeated ids, null levels and clashing column names."""
    rows = [
        (i, t, ["en", None, "de"][i % 3], ["src0", "src1", None][i % 3], len(t or ""), "k", "s", "r")
        for i, t in enumerate(plain.ODD_TEXTS)
    ]
    rows += [(3, "one", "en", "src0", 3, "k", "s", "r")] * 2  # a repeated row
    rows += [(None, "no id here", None, None, None, None, None, None)] * 2
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").cache()
