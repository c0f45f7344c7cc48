import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text[, lang[, source]]) as a documents table."""
    def make(*rows):
        full = [(*r, *(None,) * (4 - len(r)), None) for r in rows]
        return spark.createDataFrame(full, DOCS).coalesce(2)
    return make
