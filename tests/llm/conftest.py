import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LONG = "many words here and there " * 4000
AWKWARD = [None, "", " \n\t ", "a", "one two three", "é ü ñ 中文 \U0001f600", "x" * 5000, LONG, LONG, "a\n\na\n"]


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(documents):
    return {row["doc_id"]: row["text"] for row in documents.collect()}


@pytest.fixture
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns whose names operators use too."""
    rows = [(n, text, None if n % 2 else "en", None, n, "mine", n) for n, text in enumerate(AWKWARD)]
    rows += [rows[4], (None, "one two three", None, None, None, None, None), (None, None, None, None, None, None, None)]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, row string, score long"
    return spark.createDataFrame(rows, kinds)


@pytest.fixture
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(n, n % 2, n % 3 % 2) for n in range(8)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
