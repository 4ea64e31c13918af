"""The place of each row in its group, however large a group is."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from borderlake.sources.lake import stored

# Row numbers hold the number of their partition above this bit.
PART_BIT = 33


def places(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with ``place``: how many rows of the same group come before, in the given order.

    A window would order a whole group in one task. Here all rows are cut by ranges of
    (group, order), so that a large group takes as many tasks as its size asks for, even one
    whose rows share everything but the last column. Within a range the rows of a group
    follow each other; the rows it has in earlier ranges are a running sum over its ranges,
    of which there are few.

    The cut rows are stored: ranges come from a sample, and a task that ran again must not
    meet others.
    """
    spread = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    cut = stored(spread.withColumn("_row", F.monotonically_increasing_id()), "places")
    cut = cut.withColumn("_range", F.shiftright("_row", PART_BIT))
    pieces = cut.groupBy(group, "_range").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = pieces.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    placed = cut.withColumnRenamed(group, "_group").join(
        before.withColumnRenamed(group, "_of").withColumnRenamed("_range", "_in"),
        F.col("_group").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_in")),
    )
    place = F.col("_before") + F.col("_row") - F.col("_first")
    return placed.withColumn("place", place).withColumnRenamed("_group", group).select(*rows.columns, "place")
