import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


PROSE = ("Plain words make a sentence that a reader can follow without any trouble, and another one "
         "follows it with a few more words so that the paragraph has some length. ")


@pytest.fixture
def hard(spark):
    """Rows with nulls in every column, empty and very long texts, ties, repeated rows, and columns
    whose names the operators use themselves."""
    texts = [(1, "Alpha beta\tgamma delta"), (2, "alphabeta gamma  delta"), (3, None), (4, ""), (5, " \n\t"),
             (6, "word"), (7, PROSE * 3), (8, PROSE * 3), (8, PROSE * 3), (None, PROSE * 3), (None, None),
             (9, "é漢\U0001f600 " * 40), (10, PROSE + "tail of ten"), (11, ("long " + PROSE) * 4000),
             (12, "ab" * 30000), (13, "Alpha beta\tgamma delta")]
    rows = [(i, t, None if k % 3 else "en", 1.0 * k, k, "x", [k], None, "r")
            for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, score double, row long, node string, "
              "bands array<int>, host string, key string")


@pytest.fixture
def none(hard):
    return hard.limit(0)
