"""Digest trees against full comparison."""

import random

from borderlake.operators.digests import changed_rows, differing_nodes, digest_leaves, digest_tree


def versions(spark, seed=1, n=400):
    rng = random.Random(seed)
    made = [(f"k{i}", rng.choice(["a", "", None, "b"]), rng.randrange(9), f"t{i}") for i in range(n)]
    made += made[:5] + [(None, "x", 1, "t")]
    frame = lambda rows: spark.createDataFrame(rows, "k string, v string, n int, _at string")
    return made, frame


def test_a_single_changed_row_is_found_from_digests(spark):
    made, frame = versions(spark)
    other = list(made)
    other[17] = (made[17][0], "changed", made[17][2], made[17][3])
    leaves = [digest_leaves(frame(rows), "k", ("_at",)) for rows in (made, other)]
    found = differing_nodes(*leaves).collect()
    assert len(found) == 1 and found[0].rows_before == found[0].rows_after
    leaf = found[0].prefix
    path = {r.prefix for r in differing_nodes(*[digest_tree(x) for x in leaves]).collect()}
    assert path == {leaf[:n] for n in range(4)}
    sides = {(tuple(r)[:3], r.side) for r in changed_rows(frame(made), frame(other), "k", ("_at",)).collect()}
    assert sides == {(made[17][:3], "before"), (other[17][:3], "after")}


def test_order_lineage_and_time_make_no_difference(spark):
    made, frame = versions(spark)
    later = [(*r[:3], "later") for r in reversed(made)]
    leaves = [digest_leaves(frame(rows).repartition(3), "k", ("_at",)) for rows in (made, later)]
    assert differing_nodes(*leaves).isEmpty()
    assert changed_rows(frame(made), frame(later), "k", ("_at",)).isEmpty()
    root = digest_tree(leaves[0]).filter("prefix = ''").first()
    assert root.row_count == len(made)


def test_copies_nulls_lost_and_new_rows(spark):
    made, frame = versions(spark)
    other = made[1:] + [("new", None, 1, "t"), made[3]]
    other = [(r[0], "" if r[0] == "k9" and r[1] is None else r[1], *r[2:]) for r in other]
    columns = ["k", "v", "n"]
    one, two = frame(made).select(*columns), frame(other).select(*columns)
    expected = sorted([(*r, "before") for r in one.exceptAll(two).collect()] + [(*r, "after") for r in two.exceptAll(one).collect()], key=str)
    found = sorted((tuple(r) for r in changed_rows(frame(made), frame(other), "k", ("_at",)).collect()), key=str)
    assert found == expected and len(found) >= 3
    assert changed_rows(frame(made[:0]), frame(made), "k", ("_at",)).count() == len(made)
