"""The registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

import corpus_pipeline
from borderlake.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(name, spark, tmp_path):
    QUERIES[name](spark, FOLDER).write.parquet(str(tmp_path / "out"))
    base = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    base.execute(f"CREATE TABLE expected AS {ORACLE_SQL[name]}")
    columns = ", ".join(sorted(row[0] for row in base.execute("DESCRIBE expected").fetchall()))
    base.execute(f"CREATE TABLE found AS SELECT * FROM '{tmp_path}/out/*.parquet'")
    assert columns == ", ".join(sorted(row[0] for row in base.execute("DESCRIBE found").fetchall()))
    for one, other in (("found", "expected"), ("expected", "found")):
        assert base.execute(f"SELECT {columns} FROM {one} EXCEPT ALL SELECT {columns} FROM {other}").fetchall() == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_runs(name, spark):
    assert QUERIES[name](spark, FOLDER).count() >= 50


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 100
