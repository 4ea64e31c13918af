"""Publishing silver and gold as plain Parquet with a manifest.

Each publication is a folder of its own under the target. Its manifest is written last, so a
publication without one is not there for readers: they take the last that has one, and a
publication that fails leaves the one before as it is.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from borderlake.sources.lake import Lake, Snapshot, delete, exists, folders, run_id, side_by_side

# Raw personal data lives in bronze and staging; those are never published.
PUBLISHED_LAYERS = ("silver", "gold")
MANIFEST_FILE = "tables.json"
# Publications that stay: the current one and the one before, for readers still at it.
KEPT = 2

MANIFEST = (
    "schema string, table string, file string, rows bigint, columns array<struct<name: string, type: string>>"
)


def plain_types(table: DataFrame) -> DataFrame:
    """Decimals as doubles, for readers without a decimal type."""
    return table.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in table.schema.fields
        ]
    )


def publications(spark: SparkSession, target: str) -> list[str]:
    """Folders of the complete publications, the current one last."""
    return [f for f in folders(spark, target) if exists(spark, f"{f}/{MANIFEST_FILE}/_SUCCESS")]


def published_folder(spark: SparkSession, target: str) -> str:
    found = publications(spark, target)
    if not found:
        raise ValueError(f"nothing is published under {target}")
    return found[-1]


def publish(lake: Lake, target: str, also: Callable[[str, Snapshot], None] | None = None) -> DataFrame:
    """Write every silver and gold table of one build under ``target`` and describe them in a
    manifest. ``also`` may write more of that build into the publication's folder before it counts."""
    build, folder = lake.snapshot(), f"{target.rstrip('/')}/{run_id()}"

    def write(layer: str, table: str) -> tuple:
        frame = plain_types(build.table(layer, table))
        file = f"{layer}.{table}.parquet"
        seen = Observation()
        frame.observe(seen, F.count("*").alias("rows")).write.parquet(f"{folder}/{file}")
        columns = [(f.name, f.dataType.simpleString()) for f in frame.schema.fields]
        return layer, table, file, seen.get["rows"], columns

    entries = side_by_side(lake.spark, [partial(write, *found) for found in build.tables(*PUBLISHED_LAYERS)])
    if also is not None:
        also(folder, build)
    manifest = lake.spark.createDataFrame(entries, MANIFEST)
    manifest.coalesce(1).write.json(f"{folder}/{MANIFEST_FILE}")
    kept = publications(lake.spark, target)[-KEPT:]
    for old in folders(lake.spark, target):  # older ones, and what failed ones left
        if old not in kept and old.rsplit("/", 1)[1] < folder.rsplit("/", 1)[1]:
            delete(lake.spark, old)
    return manifest


def open_published(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """Read-only views ``<schema>_<table>`` over the files of the last publication and nothing else."""
    views, folder = {}, published_folder(spark, target)
    for entry in spark.read.schema(MANIFEST).json(f"{folder}/{MANIFEST_FILE}").collect():
        view = f"{entry['schema']}_{entry['table']}"
        spark.read.parquet(f"{folder}/{entry['file']}").createOrReplaceTempView(view)
        views[view] = spark.table(view)
    return views


def table_catalog(lake: Lake, *layers: str) -> DataFrame:
    """Every table and column of the given layers."""
    rows = [
        (layer, table, position, f.name, f.dataType.simpleString())
        for layer, table in lake.tables(*layers)
        for position, f in enumerate(lake.table(layer, table).schema.fields, start=1)
    ]
    return lake.spark.createDataFrame(
        rows, "table_schema string, table_name string, position int, column_name string, data_type string"
    )
