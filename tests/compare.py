"""Compare every registered query with its SQL oracle.

    python tests/compare.py [SF_DIR] [QUERY ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


SAME_TYPE = {"varchar": "string", "bigint": "bigint", "double": "double", "boolean": "boolean"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def contents(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(plain(r[i])).__name__, plain(r[i])) for i in order) for r in rows)


def difference(spark_frame, con, sql: str) -> str | None:
    """None if both sides agree in columns, types and contents."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = contents(columns, result.fetchall())
    if sorted(columns) != sorted(spark_frame.columns):
        return f"columns {sorted(spark_frame.columns)} against {sorted(columns)}"
    types = dict(spark_frame.dtypes)
    for name, kind in ((d[0], str(d[1]).lower()) for d in result.description):
        if SAME_TYPE.get(kind) != types[name]:
            return f"{name} is {types[name]} against {kind}"
    found = contents(spark_frame.columns, spark_frame.collect())
    if found == expected:
        return None
    return (
        f"{sum(found.values())} rows against {sum(expected.values())}; "
        f"only here {list((found - expected).items())[:2]}; only there {list((expected - found).items())[:2]}"
    )


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, wrong = connect(sf_dir), 0
    oracle = entry.oracle_sql()
    for name, run in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            frame = run(spark, sf_dir)
            problem = difference(frame, con, oracle[name]) if name in oracle else f"no oracle, {frame.count()} rows"
        except Exception as error:  # a failing query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        wrong += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:32s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{wrong} of {len(entry.queries())} differ")
    return wrong


if __name__ == "__main__":
    sys.exit(main())
