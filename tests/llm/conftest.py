import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from feedrank.session import get_session
    return get_session("local[*]", 8)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    long_text = "word " * 40_000 + "x" * 100_000
    rows = [(1, "a b c d e f g", "en", "s", 13, "a", 1.0), (1, "a b c d e f g", "en", "s", 13, "a", 1.0),
            (2, None, None, None, None, None, None), (3, "", "en", "s", 0, "", 0.0),
            (None, "mail me@x.example.org now", "en", None, 5, "b", 0.5),
            (4, long_text, "en", "s", len(long_text), "c", 0.1),
            (5, " \t\n\x0b ", None, "s", 5, "d", 0.1), (6, "ünï 漢字 \x1c é", "de", "s", 9, "e", 0.2),
            (7, "A B C D E F G", "en", "s", 13, "f", 0.2)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, "
              "fp string, score double")
