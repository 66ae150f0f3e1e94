import pytest

from clicklake.llm.common import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (id, text[, lang, source]) tuples."""

    def build(*rows):
        full = [(i, t, *(rest or ("en", "a")), None if t is None else len(t)) for i, t, *rest in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return build


@pytest.fixture
def odd(documents):
    """Nulls, empty, blank and long texts, copies, repeated rows, and columns whose names an operator might use itself."""
    from pyspark.sql import functions as F

    long = "lorem ipsum dolor " * 60_000
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two three"), (5, "one two three"), (5, "one two three"), (6, long), (7, "x" * 300_000), (None, "no id here"), (8, "12 34 !")]
    frame = documents(*[(i, t, None, None) for i, t in rows])
    for name in ("size", "score", "fp", "place", "toxic", "target", "piece", "words", "hits", "component_id", "_lot", "length", "node"):
        frame = frame.withColumn(name, F.lit("clash"))
    return frame
