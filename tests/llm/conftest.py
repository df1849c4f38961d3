import pytest

EXTRA = "doc_id bigint, text string, lang string, size bigint, fp bigint, row string, w int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with extra columns whose names clash with the operators' own."""

    def make(rows, langs=None):
        return spark.createDataFrame([(i, t, langs[k] if langs else None, 7, 8, "r", 9) for k, (i, t) in enumerate(rows)], EXTRA)

    return make


#: Null and empty texts, ties, repeated rows and null ids.
EDGE = [(1, None), (2, ""), (3, " \n"), (4, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (6, "one"), (7, "x" * 5000), (8, "1 2 3"), (9, "Éa É日本 <|endoftext|> don't"), (10, "w " * 3000)]


@pytest.fixture(scope="session")
def edge(make_docs):
    return make_docs(EDGE)


@pytest.fixture(scope="session")
def edge_rows():
    return EDGE
