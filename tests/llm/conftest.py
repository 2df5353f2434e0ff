import pytest

from tests.conftest import SMALL


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]


#: Null and empty texts, blanks, one word, repeats, an endless word, a long text, and odd characters.
EDGE_TEXTS = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "the cat sat on the mat " * 30), (5, "the cat sat on the mat " * 30),
    (6, "x" * 70_000), (7, "Les élèves à l'école, 　 \x1c fin 日本語テキスト 123 <|endoftext|>!! 'S 're " * 3), (None, "no id here"),
    (8, "the cat sat on the mat " * 30 + "!"), (9, "a b c d e " * 60_000), (10, "# $ % | < >"), (11, "a\nb\na\n\n\nb\nc"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Rows with clashing extra columns; host and language have nulls."""
    rows = [(i, t, "en" if n % 3 else None, "src" if n % 2 else None, len(t) if t else None, n, "k") for n, (i, t) in enumerate(EDGE_TEXTS)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words int, key string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
