import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF001 = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """documents table from texts (ids from 0) or (id, text) pairs, with a clashing extra column."""
    def make(texts, **more):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        out = spark.createDataFrame([(i, t, more.get("lang", "en"), more.get("source", "s"), len(t or "")) for i, t in rows], DOCS)
        from pyspark.sql import functions as F
        return out.withColumns({c: F.lit("x") for c in more.get("extra", ())})
    return make
