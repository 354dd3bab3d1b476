import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def llm(spark):
    """The session, with workers that find the package."""
    from utxolake.llm.common import ship_code

    ship_code(spark)
    return spark


@pytest.fixture(scope="session")
def make_docs(llm):
    """A documents table from (doc_id, text) or (doc_id, text, lang) rows; ``extra`` adds columns with the names that operators use."""

    def make(rows, extra=False):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or "")) for r in rows]
        out = llm.createDataFrame(rows, DOCS)
        if extra:
            for name in ("id", "fp", "key", "score", "component_id", "t1", "row", "has", "found", "spans", "n_words", "predicted", "start", "length", "rank", "value"):
                out = out.selectExpr("*", f"'x' as `{name}`")
        return out

    return make
