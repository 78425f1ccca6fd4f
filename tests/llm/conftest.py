import pytest

from chanlake.llm import common


@pytest.fixture(autouse=True)
def _prepared(spark):
    common.prepare(spark)


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, count string, bucket string"


@pytest.fixture()
def make_docs(spark):
    """Documents with two extra columns whose names clash with internal ones."""
    def make(rows, parts=3):
        full = [(i, t, "en", s, None if t is None else len(t), "x", "y") for i, t, s in rows]
        return spark.createDataFrame(full, DOC_SCHEMA).repartition(parts)
    return make
