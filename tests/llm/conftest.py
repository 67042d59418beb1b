from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture
def documents(spark):
    """Make documents of (doc_id, text[, lang[, source]])."""
    def make(*rows):
        whole = [(*r, *(None,) * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(whole, DOCUMENTS)

    return make


@pytest.fixture
def odd(documents):
    """Nulls, empty and long texts, repeated rows, ties."""
    long = " ".join(f"word{i}" for i in range(30_000))
    return documents(
        (1, None), (2, ""), (3, "one two three four five six seven"), (3, "one two three four five six seven"),
        (None, "no id but text"), (4, long, "en", "s"), (5, "   \n "), (6, "x" * 50_000), (7, "漢字かな交じり文 ünï 12 !?", None, "t"),
        (None, None))
