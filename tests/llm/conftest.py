import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import nasty_texts  # noqa: E402

SF = "/root/testdata/sf0.001"
CLASHES = "row long, id long, digest string, place long, run int, n long, class long, score double, component long, block long, part int, path string, words string"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("benchmark tables not present")
    return SF


@pytest.fixture()
def nasty(spark):
    """Documents with nulls, empty, blank and very long texts, ties, repeated rows and columns with clashing names."""
    rows = [(i, t, "en", "src", 1, *([None] * 13)) for i, t in nasty_texts()]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}").repartition(3)


@pytest.fixture()
def empty(nasty):
    return nasty.limit(0)
