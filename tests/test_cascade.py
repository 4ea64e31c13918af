"""Rejections along references, against a plain fixpoint."""

import random

import pytest

from borderlake.operators.cascade import fit_rows, graph_quarantine, judge_graph, parents_first
from helpers import rows


def contract(name, *references, key="id"):
    columns = [{"name": key, "type": "string", "nullable": False}]
    columns += [{"name": c, "type": "string", "nullable": null, "foreign_key": f"{p}.id"} for c, p, null in references]
    columns.append({"name": "v", "type": "decimal", "nullable": False, "min": 0})
    return {"dataset": name, "primary_key": key, "columns": columns}


def stays(tables, contracts):
    """Keys that stay, by trying until nothing changes."""
    bad = {n: set() for n in tables}
    for name, made in tables.items():
        seen = {}
        for row in set(made):
            seen.setdefault(row[0], set()).add(row)
        bad[name] |= {k for k, r in seen.items() if len(r) > 1 or any(float(x[-1]) < 0 for x in r) or k == ""}
    while True:
        before = sum(map(len, bad.values()))
        for name, c in contracts.items():
            references = [s for s in c["columns"] if s.get("foreign_key")]
            for row in tables[name]:
                for spec, value in zip(references, row[1:-1], strict=True):
                    parent = spec["foreign_key"].split(".")[0]
                    known = {r[0] for r in tables[parent]}
                    if value == "" and spec["nullable"]:
                        continue
                    if value not in known or value in bad[parent]:
                        bad[name].add(row[0])
        if sum(map(len, bad.values())) == before:
            return {n: {r[0] for r in made} - bad[n] for n, made in tables.items()}


def frames(spark, tables, contracts):
    return {
        n: spark.createDataFrame(made, ", ".join(f"{s['name']} string" for s in contracts[n]["columns"]))
        for n, made in tables.items()
    }


def test_rejection_runs_through_both_hops(spark):
    contracts = {"c": contract("c", ("b", "b", False)), "b": contract("b", ("a", "a", False)), "a": contract("a")}
    tables = {
        "a": [("a1", "-1"), ("a2", "1")],
        "b": [("b1", "a1", "1"), ("b2", "a2", "1"), ("b3", "nobody", "1")],
        "c": [("c1", "b1", "1"), ("c2", "b2", "1"), ("c3", "b3", "1"), ("c4", "b2", "-5"), ("c2", "b2", "1")],
    }
    assert parents_first(contracts) == [["a"], ["b"], ["c"]]
    judged = judge_graph(frames(spark, tables, contracts), contracts)
    found = {(r.dataset, r.record_key, r.rule, r.reason) for r in graph_quarantine(judged, contracts).collect()}
    assert found == {
        ("a", "a1", "min", "-1.0 is below minimum 0"),
        ("b", "b1", "parent_quarantined", "a a1 is quarantined"),
        ("b", "b3", "referential_integrity", "a 'nobody' not found in a"),
        ("c", "c1", "parent_quarantined", "b b1 is quarantined"),
        ("c", "c3", "parent_quarantined", "b b3 is quarantined"),
        ("c", "c4", "min", "-5.0 is below minimum 0"),
    }
    assert rows(fit_rows(judged, contracts)["c"]) == {("c2", "b2", "1")}


@pytest.mark.parametrize("seed", [1, 2])
def test_circles_and_trees_equal_a_plain_fixpoint(spark, tmp_path, seed):
    """Staff have managers, teams have leads who are staff, staff are in teams; badges hang off both."""
    contracts = {
        "badges": contract("badges", ("owner", "staff", False), ("team", "teams", True)),
        "staff": contract("staff", ("boss", "staff", True), ("team", "teams", True)),
        "teams": contract("teams", ("lead", "staff", False), ("site", "sites", False)),
        "sites": contract("sites"),
    }
    assert parents_first(contracts) == [["sites"], ["staff", "teams"], ["badges"]]
    rng = random.Random(seed)
    worth = lambda: "-1" if rng.random() < 0.04 else "1"
    pick = lambda p, n, empty: "" if empty and rng.random() < 0.4 else f"{p}{rng.randrange(n + 1)}"
    tables = {
        "sites": [(f"s{i}", worth()) for i in range(12)],
        "teams": [(f"t{i}", pick("p", 60, False), pick("s", 11, False), worth()) for i in range(20)],
        "staff": [(f"p{i}", pick("p", 60, True), pick("t", 20, True), worth()) for i in range(61)],
        "badges": [(f"b{i}", pick("p", 60, False), pick("t", 20, True), worth()) for i in range(80)],
    }
    tables["staff"].append(("p3", "", "", "2"))  # a conflict
    steps = iter(range(1000))

    def keep(made):
        kept = {}
        for name, frame in made.items():
            path = f"{tmp_path}/{next(steps)}-{name}"
            frame.write.parquet(path)
            kept[name] = spark.read.parquet(path)
        return kept

    judged = judge_graph(frames(spark, tables, contracts), contracts, keep)
    expected = stays(tables, contracts)
    assert {n: {r[0] for r in f.collect()} for n, f in fit_rows(judged, contracts).items()} == expected
    rejected = {(r.dataset, r.record_key) for r in graph_quarantine(judged, contracts).collect()}
    assert rejected == {(n, r[0]) for n, made in tables.items() for r in made if r[0] not in expected[n]}
    assert 5 < len(expected["badges"]) < 75


def test_a_reference_to_an_unknown_dataset_is_refused():
    with pytest.raises(ValueError, match="nowhere"):
        parents_first({"x": contract("x", ("y", "nowhere", False))})
