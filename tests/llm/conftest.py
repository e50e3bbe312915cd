import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make_docs(spark):
    """Rows of (doc_id, text[, source]) as a documents table with clashing extra columns."""

    def make(rows, extra=True):
        full = [
            (r[0], r[1], None, r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None, 7.5, "x") for r in rows
        ]
        kinds = DOCS + ", score double, component_id string"
        df = spark.createDataFrame(full, kinds)
        return df if extra else df.drop("score", "component_id")

    return make

