"""Uses the session of the library's tests."""

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of (doc_id, text) pairs, with further columns whose names operators use themselves."""

    def make(rows, clash=True):
        data = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        docs = spark.createDataFrame(data, SCHEMA).repartition(3)
        if clash:
            for name in ("d", "fp", "runs", "row", "kept", "n_words", "item", "digest", "stratum", "keep_id", "root", "text_sha256"):
                docs = docs.withColumn(name, F.lit("clash"))
        return docs

    return make
