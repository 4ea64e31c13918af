"""Joining a large table to a keyed one when some keys are very frequent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that one task may get; a more frequent key is cut into slices.
SLICE_ROWS = 1_000_000
# Slices are so large, if not larger, that there are at most so many. As every
# frequent key fills a slice, this bounds the broadcast list by arithmetic.
MAX_SLICES = 100_000


def hot_keys(counts: DataFrame, key: str, slice_rows: int | None = None) -> DataFrame:
    """Every key with more rows than a slice, and the number of slices it needs.

    ``counts`` has the key and its row count ``n``. Fewer than MAX_SLICES keys.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    size = F.greatest(F.lit(slice_rows or SLICE_ROWS), F.ceil(total / MAX_SLICES))
    return counts.filter(F.col("n") > size).select(key, F.ceil(F.col("n") / size).cast("int").alias("_slices"))


def count_keys(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n"))


def sliced_join(
    rows: DataFrame,
    keyed: DataFrame,
    key: str,
    how: str,
    counts: DataFrame | None = None,
    slice_rows: int | None = None,
) -> DataFrame:
    """Equi-join that spreads the rows of a frequent key over several tasks.

    The rows of such a key get a slice number from a hash of their content, so
    a rerun task gives the same slices; the other side is copied once per slice.
    Other keys have the single slice 0. Any ``how`` that keeps the left rows
    apart works: inner, left, left_semi, left_anti.

    ``counts`` (key, n) may overestimate; without it the key column of ``rows``
    is counted.
    """
    hot = F.broadcast(hot_keys(count_keys(rows, key) if counts is None else counts, key, slice_rows))
    own = F.pmod(F.xxhash64(*rows.columns), F.col("_slices")).cast("int")
    left = (
        rows.join(hot, key, "left")
        .withColumn("_slice", F.when(F.col("_slices").isNull(), F.lit(0)).otherwise(own))
        .drop("_slices")
    )
    right = (
        keyed.join(hot, key, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1)))
        .drop("_slices")
    )
    return left.join(right, [key, "_slice"], how).drop("_slice")
