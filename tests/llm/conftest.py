import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Columns whose names clash with those that the operators make.
CLASHING = "row string, n_words int, score int, n int, cls int, key int, place int, copies int"


@pytest.fixture
def documents(spark):
    """Makes documents from (doc_id, text, lang, source), with clashing further columns."""

    def make(rows):
        rows = [(*r, "r", 1, 2, 3, 4, 5, 6, 7) for r in rows]
        schema = f"doc_id bigint, text string, lang string, source string, {CLASHING}"
        return spark.createDataFrame(rows, schema)

    return make
