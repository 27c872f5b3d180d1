import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shelfspark.session import get_session

    yield get_session("local[*]", app="shelfspark-llm-tests", shuffle_partitions=8)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


EDGE_ROWS = [
    (0, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "a b c d"),
    (5, "a b c d e f g h a b c d e f g h a b c d e f g h # $ x"),
    (5, "a b c d e f g h a b c d e f g h a b c d e f g h # $ x"),
    (7, "über straße naïve 東京 は 大きい 都市 です ね 🙂 ok"),
    (None, "no id here but some words to look at in this text"),
    (9, "line one here\nline one here\n\nline two\nline one here"),
    (10, "word " * 30_000),
    (11, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null id, null and empty texts, repeated rows, a very long text, columns whose names clash with internal ones."""
    rows = [(i, t, "en", None if k % 5 == 0 else "src0", -1, "x", 3, "y") for k, (i, t) in enumerate(EDGE_ROWS)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, _s string, shard int, kept string")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.filter("doc_id < -5")
