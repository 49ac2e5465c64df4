import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """A table of documents from (doc_id, text) or whole rows; extra columns have clashing names."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, spans string, score string, bands string"
        full = [(*row, *["en", "s", 0][len(row) - 2 :], "x", "y", "z", "w") for row in rows]
        return spark.createDataFrame(full, schema)

    return make
