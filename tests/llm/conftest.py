import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text); further columns clash with names that operators use themselves."""
        table = spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in rows], DOC)
        return table.selectExpr("*", "'x' as digest", "1 as size", "'y' as kept", "2 as start", "array(1) as spans", "'k' as key")

    return make
