import pytest


@pytest.fixture
def docs(spark):
    """Builds documents from (doc_id, text[, source]), with a column that clashes with names of results."""
    def build(*rows):
        full = [(row[0], row[1], "en", row[2] if len(row) > 2 else "s", 7, "clash", "clash") for row in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score string, spans string")
    return build
