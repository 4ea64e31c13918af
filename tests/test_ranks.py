"""Places in groups against a plain sort."""

import random

from pyspark.sql import functions as F

from borderlake.operators.ranks import places


def plain(made):
    found = []
    for g in {r[0] for r in made}:
        own = sorted((r for r in made if r[0] == g), key=lambda r: (r[1], r[2]))
        found += [(*r, i) for i, r in enumerate(own)]
    return sorted(found, key=str)


def test_places_equal_a_sort(spark):
    rng = random.Random(4)
    made = [(rng.choice(["a", "b", "c", None, ""]), rng.randrange(6), f"id{i:05d}") for i in range(2000)]
    made += [("hot", 1, f"id{i:05d}") for i in range(3000)]
    rng.shuffle(made)
    table = spark.createDataFrame(made, "g string, t int, id string")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    for size in (before, "4k"):  # one range, and many
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
        found = places(table, "g", "t", "id").collect()
        assert sorted((tuple(r) for r in found), key=str) == plain(made)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert places(table.limit(0), "g", "t", "id").collect() == []


def test_one_busy_second_is_spread_over_tasks(spark):
    """All rows share customer and time; no task may get more than a fair part of them."""
    n = 200_000
    busy = spark.range(n).select(F.lit("C1").alias("g"), F.lit(0).alias("t"), F.format_string("T%09d", "id").alias("id"))
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        found = places(busy, "g", "t", "id")
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        wrong = found.filter(F.col("place") != F.substring("id", 2, 9).cast("bigint")).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert wrong == 0 and sum(sizes) == n and max(sizes) < n / 2
