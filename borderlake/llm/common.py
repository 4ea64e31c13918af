"""Helpers shared by the operators: tables in the shared folder, row ids, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Name of the row id that operators add to their input.
ROW = "_llm_row"
#: Row ids hold the number of their partition above this bit.
PART_BIT = 33
#: Bytes of text handled at a time inside a Python task.
SLICE_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, one under the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_llm"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back: this cuts the
    lineage, survives lost executors, and gives Spark the size of the table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete a table made by ``stored`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def with_row_ids(docs: DataFrame) -> DataFrame:
    """``docs`` with row ids. Two scans of one stored table number its rows alike: its splits
    are pinned, which would else follow the number of executors there happen to be."""
    spark = docs.sparkSession
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def numbered(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns with a row id."""
    return with_row_ids(docs.select(*columns))


def keep_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose row id is in ``rows``, all columns as they were."""
    return with_row_ids(docs).join(rows.select(ROW), ROW, "left_semi").drop(ROW)


def drop_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose row id is not in ``rows``, all columns as they were."""
    return with_row_ids(docs).join(rows.select(ROW), ROW, "left_anti").drop(ROW)


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder or file, for tasks."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def by_part(rows: DataFrame, label: str, *order: str) -> str:
    """Store rows with a row id by the partition of the documents they belong to; the folder.

    A later scan of the documents reads what it needs with ``read_part``, so that texts need
    no shuffle to meet what was found out about them."""
    folder = new_path(rows.sparkSession, label)
    parts = rows.withColumn("part", F.shiftright(F.col(ROW), PART_BIT))
    spread = parts.repartition("part").sortWithinPartitions("part", *order)
    spread.write.partitionBy("part").option("compression", "zstd").parquet(folder)
    return folder


def read_part(folder: str, part: int, columns: list[str]) -> pa.Table | None:
    """The rows a folder of ``by_part`` holds for one partition, in order; None if there are none."""
    system, path = file_system(f"{folder}/part={part}")
    found = system.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    names = sorted(info.path for info in found if info.path.endswith(".parquet"))
    tables = [pq.read_table(name, filesystem=system, columns=columns, partitioning=None) for name in names]
    return pa.concat_tables(tables) if tables else None


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut where the values of a text column exceed ``limit`` bytes."""
    for batch in batches:
        start, size = 0, 0
        values = batch.column(column)
        lengths = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += int(n)
        if len(batch) > start:
            yield batch.slice(start)


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [value or b"" for value in column.cast(pa.large_binary()).to_pylist()]


def arrow_map(
    df: DataFrame,
    schema: str,
    run: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    text_column: str,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """``run`` over slices of bounded size of each partition."""
    at = df.columns.index(text_column)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, at, limit):
            made = run(piece)
            if made is not None and len(made):
                yield made

    return df.mapInArrow(over, schema)
