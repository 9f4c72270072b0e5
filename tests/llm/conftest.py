import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text) or (id, text, source), with the columns of ``documents``."""

    def make(rows, extra=""):
        full = []
        for row in rows:
            doc_id, text, *rest = row
            source = rest[0] if rest else "s"
            full.append((doc_id, text, "en", source, len(text or "")))
        df = spark.createDataFrame(full, SCHEMA)
        return df.selectExpr("*", extra) if extra else df

    return make
