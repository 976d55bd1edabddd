import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Makes a table of documents from texts, or from (doc_id, text)."""

    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def clashing(documents):
    """The same table with more columns, named like the operators' own ones."""

    def make(rows):
        df = documents(rows)
        for name in ("id", "t", "row", "key", "fp", "digest", "keep_id", "kept", "node", "score"):
            df = df.withColumn(name, df["lang"])
        return df

    return make
