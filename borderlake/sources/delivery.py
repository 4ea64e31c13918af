"""CSV deliveries: reading them into raw tables unchanged, and writing them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from borderlake.sources.lake import shared_folder
from borderlake.sources.quoted import BORDER, BORDER_TYPE, HEADER, assemble, stitched, true_states

CORRUPT = "_corrupt_record"
DIALECT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# Partition of a loaded folder: its records, and what its splits said about their borders.
PART, RECORDS, BORDERS = "_load", "records", "borders"
# Lets a task write both partitions without sorting its rows by partition first.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


class Loaded(NamedTuple):
    """Where the records of a delivery lie, their columns and number."""

    folder: str
    schema: StructType
    rows: int


def header(spark: SparkSession, path: str) -> list[str]:
    names = [n.lstrip("\ufeff") for n in spark.read.options(**DIALECT, multiLine=True).csv(path).columns]
    if not names:
        raise ValueError(f"no data under {path}")
    return names


def parsed(rows: DataFrame, names: list[str], loaded_at: str) -> DataFrame:
    """Rows of ``assemble`` as delivered columns with lineage. A header must be the expected one."""
    ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in [*names, CORRUPT])
    options = {**{k: str(v) for k, v in DIALECT.items() if k != "header"}, "multiLine": "true", "columnNameOfCorruptRecord": CORRUPT}
    whole = F.when(F.col("kind") != BORDER, F.from_csv("text", ddl, options))
    cells = rows.withColumn("_r", whole)

    def field(name: str) -> Column:
        return F.col("_r").getField(name)

    corrupt = field(CORRUPT)
    unquoted = F.regexp_replace(corrupt, r'"([^"]|"")*"', "")
    fields = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1
    too_long = F.concat(F.lit(f"record with more than {len(names)} fields in "), F.col("name"))
    never_closed = F.concat(F.lit("quoted field that is not closed in "), F.col("name"))
    other = F.concat(F.lit("header that differs from the first file's in "), F.col("name"))
    quotes = F.length("text") - F.length(F.replace(F.col("text"), F.lit('"'), F.lit("")))
    same = F.lit(True)
    for n in names:
        same = same & (F.regexp_replace(F.coalesce(field(n), F.lit("")), "^\ufeff", "") == n)
    kind = F.col("kind")
    checked = (
        F.when(kind == BORDER, True)
        .when(quotes % 2 == 1, F.raise_error(never_closed).cast("boolean"))
        .when(fields > len(names), F.raise_error(too_long).cast("boolean"))
        .when((kind == HEADER) & ~same, F.raise_error(other).cast("boolean"))
        .otherwise(kind != HEADER)
    )
    # The borders of a split travel in the first column, as JSON.
    first = F.when(kind == BORDER, F.to_json(F.struct("file", "name", "border.*"))).otherwise(F.coalesce(field(names[0]), F.lit("")))
    rest = [F.coalesce(field(n), F.lit("")).alias(n) for n in names[1:]]
    part = F.when(kind == BORDER, F.lit(BORDERS)).otherwise(F.lit(RECORDS))
    return cells.filter(checked).select(
        first.alias(names[0]), *rest, F.lit(loaded_at).alias("_ingested_at"), F.col("name").alias("_source_file"), part.alias(PART)
    )


@contextmanager
def _two_writers(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(WRITERS, None)
    spark.conf.set(WRITERS, "2")
    try:
        yield
    finally:
        spark.conf.unset(WRITERS) if before is None else spark.conf.set(WRITERS, before)


def load_csv(spark: SparkSession, path: str, loaded_at: str, folder: str) -> Loaded:
    """Store a delivery under ``folder`` as text, just as it came, with two lineage columns.

    Empty fields are empty text and ``NA`` is ``NA``. A record with more fields than the
    header, a quoted field that is never closed and a file with another header fail the load;
    a short record reads as empty at the end.

    One pass over the text. Files are split, however large, and whether or not quoted fields
    hold line breaks (see ``quoted``).
    """
    names, states = header(spark, path), {}
    border_schema = "file string, name string, block bigint, guess int, parity int, head string, tail string, header boolean"
    while True:
        seen = Observation()
        made = parsed(assemble(spark, path, states), names, loaded_at)
        counted = made.observe(seen, F.count_if(F.col(PART) == RECORDS).alias("rows"))
        with _two_writers(spark):
            counted.write.mode("overwrite").partitionBy(PART).parquet(folder)
        columns = StructType([f for f in made.schema.fields if f.name != PART])
        told = spark.read.schema(columns).parquet(f"{folder}/{PART}={BORDERS}")
        borders = told.select(F.from_json(F.col(f"`{names[0]}`"), border_schema).alias("b")).select("b.*")
        wrong = true_states(borders).filter("state <> guess").select("file", "block", "state").collect()
        if not wrong:
            break
        states.update({(r["file"], r["block"]): int(r["state"]) for r in wrong})
    records = f"{folder}/{PART}={RECORDS}"
    crossing = parsed(stitched(borders).withColumn("border", F.lit(None).cast(BORDER_TYPE)), names, loaded_at)
    more = Observation()
    crossing.drop(PART).observe(more, F.count("*").alias("rows")).write.mode("append").parquet(records)
    return Loaded(records, columns, seen.get["rows"] + more.get["rows"])


def read_csv(spark: SparkSession, path: str, loaded_at: str) -> DataFrame:
    """A delivery as a table, loaded into a scratch folder."""
    loaded = load_csv(spark, path, loaded_at, shared_folder(spark, "csv"))
    return spark.read.schema(loaded.schema).parquet(loaded.folder)


def write_csv(table: DataFrame, fields: list[str], path: str) -> None:
    """Write a delivery with a header and a fixed order of fields."""
    table.select(*fields).write.mode("overwrite").options(**DIALECT, emptyValue="").csv(path)
