from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) or (doc_id, text, source) rows."""
    def make(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


ODD_TEXTS = [None, "", " ", "a", "ß é 漢字 \U0001f600", "x" * 30_000, "one two three four five " * 4_000, "same text here", "same text here", "tab\tand\x0bline\nends\x00nul"]


@pytest.fixture(scope="session")
def odd(docs_of):
    """Null and empty texts, a null id, a null source, very long texts, repeated rows, and an empty row."""
    rows = [(i, t, "s" if i % 2 else None) for i, t in enumerate(ODD_TEXTS)]
    return docs_of([*rows, (None, "no id", "s"), (None, None, None), (3, "a", "s"), (3, "a", "s")])
