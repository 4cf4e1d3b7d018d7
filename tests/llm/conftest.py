import pytest


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text, ...) rows; the columns after text are source and lang."""

    def make(rows, extra=""):
        full = [(*r, *(None,) * (4 - len(r))) if len(r) < 4 else r for r in rows]
        return spark.createDataFrame(full, f"doc_id bigint, text string, source string, lang string{extra}")

    return make
