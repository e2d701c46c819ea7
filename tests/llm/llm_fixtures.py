"""Awkward documents shared by the operator tests."""

import pytest

LONG = " ".join(f"word{i % 977} item{i % 31}." for i in range(30_000))

# Null and empty texts, white space, ties, repeated rows, a very long text.
TEXTS = [
    (7, "The first line here\nshared line of text\nshort\nshared line of text"),
    (3, "SHARED LINE OF TEXT  \nanother line only here\r\n\t\nshort"),
    (3, "SHARED LINE OF TEXT  \nanother line only here\r\n\t\nshort"),
    (11, None),
    (12, ""),
    (13, "   \n\t "),
    (14, "é日本 'll  don't   stop now <|endoftext|> 12,345"),
    (None, "a row without an id\nshared line of text"),
    (20, LONG),
    (21, LONG + " tail"),
    (22, "x" * 5000),
    (23, "one two three four"),
    (24, "One TWO three\nfour"),
    (25, "99 - !!"),
]


@pytest.fixture(scope="session")
def llm(spark):
    from kasir.llm.common import prepare
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def docs(llm):
    """The texts with extra columns whose names clash with working names."""
    rows = [(i, t, "a", 1, 2.0, b"z", "s") for i, t in TEXTS]
    return llm.createDataFrame(rows, "doc_id bigint, text string, salt string, n bigint, score double, "
                                     "ids binary, start string")


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
