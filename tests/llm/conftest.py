import os
import sys

import pytest

from llm_rows import doc_rows

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("doc_id long, text string, lang string, source string, n_chars long, size long, shard int, score double, "
         "_text string, key long, bucket long, n long, component string")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """With extra columns whose names operators use inside."""
    rows = [(*r, 7, 7, 0.5, "t", 7, 7, 7, "c") for r in doc_rows()]
    return spark.createDataFrame(rows, CLASH).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
