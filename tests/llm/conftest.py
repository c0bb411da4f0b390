import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source) tuples, with columns whose names clash."""

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", 1, "x", 2) for r in rows]
        return spark.createDataFrame(full, DOCS + ", row string, size bigint")

    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


ODD = [
    (1, None), (2, ""), (3, " \t\n"), (None, "some words without an id"), (4, "the same words here"), (4, "the same words here"),
    (5, "the  same\twords here"), (6, "w" * 30_000), (7, "many words " * 20_000), (8, "<|endoftext|> \x1c ünï ́   x"),
]


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and very long texts, ties and repeated rows."""
    return make_docs(*ODD)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
