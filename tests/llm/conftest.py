import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, with columns whose names
    operators use inside."""

    def make(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0) for r in rows]
        frame = spark.createDataFrame(full, DOCS).repartition(3)
        if extra:
            from pyspark.sql import functions as F

            for name in ("id", "row", "key", "fp", "shard", "kind", "found", "start", "words"):
                frame = frame.withColumn(name, F.lit("x"))
        return frame

    return make


@pytest.fixture
def table(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
