import pytest

LONG = "alpha beta gamma delta " * 4000
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a"),
    (3, None, "en", "a"), (4, "", None, None), (5, "   \n\t ", "de", "b"), (6, "Straße über Äpfel 🙂 日本", "de", "b"),
    (7, LONG, "en", "b"), (8, "one two", None, "c"), (9, "12345 --- 678", "en", "c"),
    (None, "a text without an id", "en", "c"), (10, "one  two", "fr", None),
]


@pytest.fixture()
def odd_docs(spark):
    """Nulls in every column, empty, blank, long, equal and repeated rows,
    and extra columns whose names operators use themselves."""
    rows = [(i, t, lang, s, None if i is None else i * 10, "x", 1.5) for i, t, lang, s in TEXTS + TEXTS[:1]]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, block long, ids string, score double")


@pytest.fixture()
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def vocabularies():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path
