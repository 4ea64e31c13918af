"""Joins with very frequent keys."""

import random

import pytest
from pyspark.sql import functions as F

from borderlake.operators import skew
from borderlake.operators.skew import count_keys, hot_keys, sliced_join


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(7)
    keys = ["hot"] * 400 + ["warm"] * 90 + [f"k{rng.randint(0, 60)}" for _ in range(500)] + ["orphan"] * 60
    facts = spark.createDataFrame(list(enumerate(keys)), "id int, key string").repartition(5)
    keyed = spark.createDataFrame([(k, i) for i, k in enumerate(sorted(set(keys) - {"orphan"}))] + [("idle", 99)], "key string, v int")
    return facts, keyed


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("slice_rows", [1, 7, 80, 1000])
def test_same_rows_as_a_plain_join(tables, how, slice_rows):
    facts, keyed = tables
    plain = facts.join(keyed, "key", how)
    sliced = sliced_join(facts, keyed, "key", how, slice_rows=slice_rows)
    assert sliced.columns == plain.columns
    assert sorted(map(tuple, sliced.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_several_rows_per_key_on_the_right(tables):
    facts, keyed = tables
    twice = keyed.union(keyed.withColumn("v", F.col("v") + 1000))
    assert sliced_join(facts, twice, "key", "inner", slice_rows=50).count() == facts.join(twice, "key").count()


def test_a_hot_key_is_cut_into_slices_of_bounded_size(tables):
    facts, _ = tables
    hot = {r.key: r._slices for r in hot_keys(count_keys(facts, "key"), "key", 40).collect()}
    assert hot == {"hot": 10, "warm": 3, "orphan": 2}
    own = F.pmod(F.xxhash64("id", "key"), F.lit(10))
    sizes = [r["count"] for r in facts.filter("key = 'hot'").groupBy(own).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 80


def test_the_list_of_hot_keys_is_bounded_and_the_rest_still_joins(tables, monkeypatch):
    """With at most four slices of 1050 rows, a slice has 263: only one key is larger."""
    facts, keyed = tables
    monkeypatch.setattr(skew, "MAX_SLICES", 4)
    assert [(r.key, r._slices) for r in hot_keys(count_keys(facts, "key"), "key", 5).collect()] == [("hot", 2)]
    assert sliced_join(facts, keyed, "key", "left", slice_rows=5).count() == facts.count()


def test_overestimated_counts_do_no_harm(tables):
    facts, keyed = tables
    counts = count_keys(facts, "key").withColumn("n", F.col("n") * 9)
    assert sliced_join(facts, keyed, "key", "inner", counts, 20).count() == facts.join(keyed, "key").count()
