import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """Builds a documents table from (doc_id, text[, lang[, source]]) rows, with columns beyond
    those of the contract whose names operators also use."""

    def build(rows, extra=True):
        full = []
        for r in rows:
            doc_id, text, lang, source = (*r, None, None)[:4] if len(r) < 4 else r
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, COLUMNS)
        if extra:
            from pyspark.sql import functions as F

            for name in ("score", "held_out", "n", "tokens", "spans", "token", "cid", "batch"):
                df = df.withColumn(name, F.lit("x"))
        return df

    return build
