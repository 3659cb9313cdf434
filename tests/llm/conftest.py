import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """Documents from texts, or (doc_id, text) pairs; with columns whose names clash with inner ones."""
    def build(rows, extra=False):
        rows = [r if isinstance(r, tuple) else (k, r) for k, r in enumerate(rows)]
        full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            for name in ("node", "row", "gone", "rec", "key", "line", "kept", "component", "tokens", "topic", "id", "words", "_words", "n", "weight"):
                df = df.selectExpr("*", f"'x' as {name}")
        return df

    return build
