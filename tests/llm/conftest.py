import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, repeated rows, ties, a long text and clashing extra columns."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
    rows = [(0, "", "en", "s", 0), (1, None, None, None, None), (2, " \n\t ", "en", "s", 4), (3, "a b", "en", "s", 3),
            (None, "a text without an id " * 20, "en", "s", 1), (5, long, "en", "s", len(long)),
            (6, "same words again and again " * 12, "fr", "s", 1), (6, "same words again and again " * 12, "fr", "s", 1),
            (7, "same words again and again " * 12, None, "s", 1), (8, "日本語 тест ελλ 🙂 é́", "xx", None, 9)]
    df = spark.createDataFrame(rows, DOCS)
    extra = {c: __import__("pyspark.sql.functions", fromlist=["lit"]).lit(1)
             for c in ("n", "k", "run", "bucket", "band", "fp", "label", "score", "term", "key", "spans", "base", "ids")}
    return df.withColumns(extra)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
