import pytest

#: Cases that every operator has to take: null and empty texts, blanks, repeated rows, a null key, a long text.
ODD = [(1, "", "s"), (2, None, "s"), (3, " \n\t", None), (4, "one two three", "s"), (4, "one two three", "s"),
       (None, "one two three", "s"), (None, None, None), (5, "word " * 30_000, "long"), (6, "é ñ ß " * 5, "s")]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with a column whose name many operators use inside."""
    return spark.createDataFrame([(*r, "x", 7) for r in ODD], "doc_id long, text string, source string, content string, key int")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """Texts of the small table by id."""
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
