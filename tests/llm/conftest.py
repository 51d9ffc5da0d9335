import pytest


DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Columns whose names clash with what operators make inside or return.
CLASHING = ["n_words", "digest", "block", "words", "spans", "row", "kind", "u", "v", "node", "x", "s", "kept", "tokens", "component_id", "rep", "sig", "start"]


@pytest.fixture(scope="session")
def docs_of(spark):
    from userlens.llm.shared import ship

    ship(spark)

    def make(rows, clashing=False):
        """rows: (doc_id, text)."""
        df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
        if clashing:
            from pyspark.sql import functions as F
            df = df.select("*", *[F.lit("clash").alias(c) for c in CLASHING])
        return df

    return make


@pytest.fixture(scope="session")
def real(spark):
    """(documents, as a list of pairs) of the smallest given table."""
    import os

    from userlens.llm.shared import ship

    ship(spark)
    at = "/root/testdata/sf0.001"
    if not os.path.isdir(at):
        pytest.skip("driver test data not present")
    df = spark.read.parquet(f"{at}/documents.parquet")
    return df, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
