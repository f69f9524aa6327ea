import pytest

#: Null id and text, empty texts, ties, repeated rows, a very long text, other scripts.
HARD = [
    (1, None), (2, ""), (3, ""), (None, "a text without an id"), (4, " \t\n\r "), (5, "word " * 30_000), (6, "same words in two rows"),
    (6, "same words in two rows"), (7, "日本語 テスト é ß İ ſ     x\x00y"), (8, "x" * 100_000), (9, "\n\n\n"), (10, "One. Two!\nThree?"),
]


@pytest.fixture
def docs(spark):
    """(rows, also with columns named like results) -> documents."""

    def make(rows, clash=()):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        for name in clash:
            df = df.selectExpr("*", f"'kept' AS `{name}`")
        return df

    return make


@pytest.fixture
def hard(docs):
    return docs(HARD)


@pytest.fixture
def empty(docs):
    return docs([])
