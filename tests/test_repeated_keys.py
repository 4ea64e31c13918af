"""Only rows whose key is repeated are grouped as whole rows; all others pass as they are."""

from borderlake.operators import judge as judging
from borderlake.operators.contracts import load_contracts
from borderlake.operators.judge import VERSIONS, judge
from borderlake.sources.lake import stored

C = "customer_id first_name last_name sa_id_number email phone province signup_date home_region".split()
T = "transaction_id customer_id amount_zar currency merchant txn_timestamp processing_region".split()
PERSON = ("A", "B", "8001015009087", "a@b.c", "+27821234567", "Gauteng", "2024-02-29", "af-south-1")
MOVE = ("C1", "10.00", "ZAR", "Shop", "2024-01-01T10:00:00")


def raw(spark, people, moves):
    return {
        "customers": spark.createDataFrame(people, ", ".join(f"{c} string" for c in C)),
        "transactions": spark.createDataFrame(moves, ", ".join(f"{c} string" for c in T)),
    }


def judged_with_steps(spark, people, moves):
    seen = {}

    def keep(frames):
        seen.update({name: stored(frame, "step") for name, frame in frames.items()})
        return {name: seen[name] for name in frames}

    return judge(raw(spark, people, moves), load_contracts(), keep), seen


def deliveries():
    people = [(f"C{i}", *PERSON) for i in range(30)] + [(" C7 ", *PERSON), ("C8", "Other", *PERSON[1:]), ("", *PERSON), (None, *PERSON)]
    moves = [(f"T{i}", *MOVE, "af-south-1") for i in range(200)]
    moves += [(" T5", *MOVE, "af-south-1"), ("T6", *MOVE, "eu-west-1"), ("T6", *MOVE, "us-east-1"), ("T6", *MOVE, "us-east-1")]
    return people, moves


def test_whole_rows_are_grouped_for_repeated_keys_only(spark):
    judged, seen = judged_with_steps(spark, *deliveries())
    assert sorted(r[0] for r in seen["customers_rows"].select("customer_id").collect()) == ["", "C7", "C8", "C8"]
    assert sorted(r[0] for r in seen["transactions_rows"].select("transaction_id").collect()) == ["T5", "T6", "T6", "T6"]
    versions = {r.transaction_id: r[VERSIONS] for r in judged["transactions"].collect()}
    assert judged["transactions"].count() == 202 and len(versions) == 200
    assert {k: n for k, n in versions.items() if n > 1} == {"T6": 3}
    assert {r.customer_id for r in judged["customers"].filter(f"{VERSIONS} > 1").collect()} == {"C8"}


def test_keys_that_share_a_mark_stay_apart(spark, monkeypatch):
    before = judge(raw(spark, *deliveries()), load_contracts())
    monkeypatch.setattr(judging, "MARKS", 3)
    after, seen = judged_with_steps(spark, *deliveries())
    assert seen["transactions_rows"].count() > 4
    for name, table in before.items():
        own = after[name].select(*table.columns)
        assert table.exceptAll(own).count() == own.exceptAll(table).count() == 0
