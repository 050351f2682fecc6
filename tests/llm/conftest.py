from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents of (id, text) pairs, with columns whose names operators use inside."""

    def make(rows):
        full = [(i, t, "en", f"src{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
        df = spark.createDataFrame(full, DOCUMENTS)
        for name in ("id", "fp", "block", "rep", "node", "component", "score", "ids", "label", "bucket", "spans", "least"):
            df = df.selectExpr("*", f"'other' AS {name}")
        return df

    return make
