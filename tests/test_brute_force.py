"""Quarantine and silver against a row-by-row judge in plain Python, on messy random data."""

import random
from collections import Counter, defaultdict

import pytest

from borderlake.functions.residency import load_policy
from borderlake.operators import skew
from borderlake.operators.contracts import GOVERNANCE, load_contracts
from borderlake.operators.judge import judge, quarantine
from borderlake.operators.set_checks import set_check_violations
from borderlake.operators.silver import silver_customers, silver_transactions

from helpers import KEY, rows

C = "customer_id first_name last_name sa_id_number email phone province signup_date home_region".split()
T = "transaction_id customer_id amount_zar currency merchant txn_timestamp processing_region".split()
HOMES = ["af-south-1", "af-south-1", "eu-west-1", "ap-south-1"]


def messy(seed):
    rng = random.Random(seed)
    people = []
    for i in range(60):
        row = [f"C{i}", "A", "B", "8001015009087", "a@b.c", "+27821234567", "Gauteng", "2024-02-29", rng.choice(HOMES)]
        for column, bad in ((1, " "), (3, "8001015009088"), (4, "x"), (5, ""), (6, "Atlantis"), (7, "2023-02-29"), (8, "")):
            if rng.random() < 0.04:
                row[column] = bad
        people.append(row)
        if rng.random() < 0.15:
            people.append(list(row))  # a copy
        if rng.random() < 0.08:
            people.append([*row[:8], rng.choice(HOMES)])  # perhaps a conflict, with another home
    people.append(["", *people[0][1:]])
    moves = []
    for i in range(500):
        owner = "C1" if rng.random() < 0.35 else f"C{rng.randint(0, 64)}"  # one owner has a third of all
        region = rng.choice(["af-south-1"] * 6 + ["eu-west-1", "us-east-1", "ap-south-1"])
        row = [f"T{i}", owner, f"{rng.uniform(1, 99):.2f}", "ZAR", "M", "2026-01-02T03:04:05", region]
        for column, bad in ((1, ""), (1, f" {owner}\t"), (2, "-1"), (2, "abc"), (3, "USD"), (4, ""), (5, "late"), (6, "")):
            if rng.random() < 0.02:
                row[column] = bad
        moves.append(row)
        if rng.random() < 0.1:
            moves.append(list(row))
        if rng.random() < 0.2:
            moves.append(["T7", *row[1:]])  # one key has many different rows
    return people, moves


def judge_by_hand(people, moves):
    """(dataset, key, rule) of every reason, and the keys that stay."""
    people = {tuple([r[0].strip(), *r[1:]]) for r in people}
    moves = {tuple([r[0].strip(), r[1].strip(), *r[2:]]) for r in moves}
    reasons, homes = set(), defaultdict(set)
    required = [0, 1, 2, 3, 4, 6, 7, 8]
    bad_values = {3: ("8001015009088", "sa_id"), 4: ("x", "email"), 6: ("Atlantis", "allowed_values"), 7: ("2023-02-29", "type")}
    for r in people:
        homes[r[0]].add(r[8].strip())
        reasons |= {("customers", r[0], "not_null") for c in required if not r[c].strip()}
        reasons |= {("customers", r[0], rule) for c, (bad, rule) in bad_values.items() if r[c] == bad}
    for key, n in Counter(r[0] for r in people).items():
        if n > 1:
            reasons.add(("customers", key, "unique"))
    rejected = {k for d, k, _ in reasons if d == "customers"}
    for r in moves:
        key, owner, amount, currency, _, when, region = r

        def add(rule, broken, key=key):
            if broken:
                reasons.add(("transactions", key, rule))

        add("not_null", any(not c.strip() for c in r))
        add("type", amount == "abc" or when == "late")
        add("min", amount in ("-1", "abc"))
        add("allowed_values", currency == "USD")
        add("referential_integrity", owner not in homes)
        add("parent_quarantined", owner in rejected)
        permitted = ("af-south-1", "eu-west-1", "us-east-1")
        add("residency_blocked", any(h != region and region not in permitted for h in homes.get(owner, ())))
    for key, n in Counter(r[0] for r in moves).items():
        if n > 1:
            reasons.add(("transactions", key, "unique"))
    out = {k for d, k, _ in reasons if d == "transactions"}
    return reasons, {r[0] for r in people} - rejected, {r[0] for r in moves} - out


@pytest.mark.parametrize("seed, slice_rows", [(1, 1_000_000), (2, 10), (3, 3)])
def test_same_verdicts_as_by_hand(spark, monkeypatch, seed, slice_rows):
    monkeypatch.setattr(skew, "SLICE_ROWS", slice_rows)
    people, moves = messy(seed)
    tables = {
        "customers": spark.createDataFrame(people, ", ".join(f"{c} string" for c in C)),
        "transactions": spark.createDataFrame(moves, ", ".join(f"{c} string" for c in T)),
    }
    contracts, policy = load_contracts(), load_policy(GOVERNANCE / "residency.yml")
    reasons, kept_customers, kept_transactions = judge_by_hand(people, moves)
    judged = judge(tables, contracts)
    q = quarantine(judged, contracts, policy)
    assert {(r.dataset, r.record_key, r.rule) for r in q.collect()} == reasons
    assert len({r.rule for r in q.select("rule").collect()}) >= 9
    customers = silver_customers(judged["customers"], contracts["customers"], KEY).collect()
    transactions = silver_transactions(judged["transactions"], contracts["transactions"], policy).collect()
    assert sorted(r.customer_id for r in customers) == sorted(kept_customers)
    assert sorted(r.transaction_id for r in transactions) == sorted(kept_transactions)
    home = {r.customer_id: r.home_region for r in customers}
    assert all(r.home_region == home[r.customer_id] for r in transactions)
    set_rules = {"unique", "referential_integrity"}
    found = {(d, k, rule) for d, k, _, rule, _ in rows(set_check_violations(tables, contracts))}
    assert found == {r for r in reasons if r[2] in set_rules}
