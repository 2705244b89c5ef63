import pytest


@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text[, source]) rows."""

    def build(rows, extra=False):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        if extra:  # columns named like those of results and like helpers
            from pyspark.sql import functions as F

            for name in ("n_words", "_row", "_id", "score", "size", "kept_text", "_fp", "component_id", "n_hit"):
                df = df.withColumn(name, F.lit("own"))
        return df

    return build


ODD_TEXTS = [
    (1, None), (2, ""), (3, " \t\r\n"), (4, "\n\n"), (5, "x"), (5, "x"), (6, "A b C d"), (7, "a B c D"),
    (8, "é" * 5000), (9, "word " * 30000), (10, None), (11, "\x00\x1f\x85   z"), (None, "no id at all"),
]
