from __future__ import annotations

import pytest
from pyspark.sql import types as T

from citelake.llm.shipping import ship

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def llm(spark, tmp_path_factory):
    """The session of the other tests, with the library shipped and a checkpoint folder."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def documents(llm):
    """Make a documents table from texts; ids count from 1."""

    def make(texts, ids=None, sources=None):
        ids = list(ids) if ids is not None else list(range(1, len(texts) + 1))
        sources = sources or ["s"] * len(texts)
        rows = [
            (i, x, "en", s, None if x is None else len(x))
            for i, x, s in zip(ids, texts, sources, strict=True)
        ]
        return llm.createDataFrame(rows, DOCUMENTS)

    return make
