import pytest


@pytest.fixture
def odd_documents(spark):
    """Nulls, empty and long texts, ties, repeated rows."""
    long = " ".join(f"word{i % 997}" for i in range(5000))
    rows = [(1, "", "en", "a", 0), (2, None, None, None, None), (None, "one two three four five six", "en", "a", 27), (4, long, "en", "b", len(long)), (4, long, "en", "b", len(long)), (5, long + " more", "en", "b", None), (6, "a b", "en", "c", 3), (7, "a b", "en", "c", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
