"""Small tables with every awkward row, stored as the operators ask for."""

import pytest
from awkward import CLASHES, TEXTS
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def stored_table(spark, tmp_path_factory):
    def store(rows, schema):
        frame = spark.createDataFrame(rows, schema)
        for name in CLASHES:
            if name not in frame.columns:
                frame = frame.withColumn(name, F.lit("clash"))
        path = str(tmp_path_factory.mktemp("table") / "t.parquet")
        frame.repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return store


@pytest.fixture(scope="session")
def odd(stored_table):
    rows = [(i, text, "en" if (i or 0) % 2 else "fr", "src", len(text or "")) for i, text in TEXTS]
    return stored_table(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def empty(stored_table):
    return stored_table([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def small(spark):
    """The documents of the smallest test tables."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
