import numpy as np
import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("key", T.StringType()),
    T.StructField("node", T.StringType()), T.StructField("part", T.StringType()), T.StructField("root", T.StringType()),
])


@pytest.fixture
def docs(spark):
    """A documents table with extra columns whose names operators use inside."""

    def make(rows):
        full = []
        for r in rows:
            doc_id, text, lang, source = (*r, "en", "s")[:4] if len(r) == 2 else r
            full.append((doc_id, text, lang, source, None if text is None else len(text), "k", "n", "p", "r"))
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def prose():
    """Random words of a small vocabulary, from a seed."""

    def make(seed, n, vocabulary=5_000):
        rng = np.random.default_rng(seed)
        return " ".join(f"w{x}" for x in rng.integers(0, vocabulary, n))

    return make
