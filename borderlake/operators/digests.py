"""Digest trees: where two versions of a table differ, found from digests alone.

The leaves of a tree are ranges of the hash of the key, written as hexadecimal prefixes; a
leaf has the number of its rows and an order-free sum of their digests. An inner node is the
sum of its children, so the root speaks for the whole table. A tree has at most
16 ** depth leaves however large the table is, and comparing two trees reads neither table:
only the leaves below differing nodes can hold a difference, and only their rows need be read
to see it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hexadecimal digits of a leaf's prefix: 4096 leaves.
DEPTH = 3
MODULUS = 1_000_000_000_000_000


def row_digest(table: DataFrame, volatile: tuple[str, ...] = ()) -> Column:
    """A number from everything a row says. NULL differs from empty text."""
    columns = sorted(c for c in table.columns if c not in volatile)
    text = F.concat_ws("\x02", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x01")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def leaf_of(key: str, depth: int) -> Column:
    return F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("\x01"))), 1, depth)


def digest_leaves(table: DataFrame, key: str, volatile: tuple[str, ...] = (), depth: int = DEPTH) -> DataFrame:
    """(prefix, row_count, content_sum) of every leaf that has rows, from one scan."""
    marked = table.select(leaf_of(key, depth).alias("prefix"), row_digest(table, volatile).alias("_digest"))
    total = (F.sum(F.col("_digest").cast("decimal(38,0)")) % MODULUS).cast("bigint")
    return marked.groupBy("prefix").agg(F.count("*").alias("row_count"), total.alias("content_sum"))


def digest_tree(leaves: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The leaves and all nodes above them; the root has the empty prefix."""
    nodes = leaves.withColumn("node", F.explode(F.array(*[F.substring("prefix", 1, n) for n in range(depth + 1)])))
    total = (F.sum(F.col("content_sum").cast("decimal(38,0)")) % MODULUS).cast("bigint")
    summed = nodes.groupBy("node").agg(F.sum("row_count").alias("row_count"), total.alias("content_sum"))
    return summed.withColumnRenamed("node", "prefix")


def differing_nodes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Nodes that two trees do not agree on: prefix, rows in the one and in the other."""
    one = before.select("prefix", F.col("row_count").alias("rows_before"), F.col("content_sum").alias("_one"))
    two = after.select("prefix", F.col("row_count").alias("rows_after"), F.col("content_sum").alias("_two"))
    both = one.join(two, "prefix", "full").fillna(0, ["rows_before", "rows_after"])
    same = F.col("_one").eqNullSafe(F.col("_two")) & (F.col("rows_before") == F.col("rows_after"))
    return both.filter(~same).select("prefix", "rows_before", "rows_after")


def changed_rows(
    before: DataFrame, after: DataFrame, key: str, volatile: tuple[str, ...] = (), depth: int = DEPTH
) -> DataFrame:
    """Rows that only one of two versions has, copies counted. Full rows are compared in the
    leaves that differ only; the others are ruled out by their digests."""
    leaves = differing_nodes(*(digest_leaves(t, key, volatile, depth) for t in (before, after)))
    columns = [c for c in before.columns if c not in volatile]

    def suspects(table: DataFrame) -> DataFrame:
        marked = table.withColumn("_leaf", leaf_of(key, depth))
        found = F.broadcast(leaves.select(F.col("prefix").alias("_leaf")))  # at most 16 ** depth rows
        return marked.join(found, "_leaf", "left_semi").select(*columns)

    old, new = suspects(before), suspects(after)
    return old.exceptAll(new).withColumn("side", F.lit("before")).unionByName(
        new.exceptAll(old).withColumn("side", F.lit("after"))
    )
