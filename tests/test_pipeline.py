"""The whole build on synthetic deliveries with nine known faults."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from borderlake.functions.residency import load_policy
from borderlake.operators import assurance
from borderlake.operators.contracts import GOVERNANCE, load_contracts
from borderlake.operators.judge import judge, quarantine, reasons, wording
from borderlake.operators.leaks import personal_values, said_values, words
from borderlake.operators.reports import preview, subject_transfers, transfer_rows
from borderlake.operators.silver import silver_customers, silver_transactions
from borderlake.plans import pipeline
from borderlake.plans.pipeline import run
from borderlake.sources import synthetic as syn
from borderlake.sources.delivery import write_csv
from borderlake.sources.lake import Lake

from helpers import KEY, rows

EXPECTED = {
    ("customers", "C00001", "sa_id"),
    ("customers", "C00002", "email"),
    ("customers", "C00003", "allowed_values"),
    ("customers", "C00004", "not_null"),
    ("transactions", "T000001", "min"),
    ("transactions", "T000001", "unique"),
    ("transactions", "T000002", "allowed_values"),
    ("transactions", "T000003", "not_null"),
    ("transactions", "T001000", "referential_integrity"),
}


def synthetic(spark, n=syn.N_TRANSACTIONS, n_customers=syn.N_CUSTOMERS, partitions=3):
    people = syn.customers(spark.range(1, n_customers + 1, 1, partitions))
    moves = syn.transactions(spark.range(1, n + 1, 1, partitions), n, n_customers, n // 25)
    return {
        "customers": syn.inject_customer_faults(people).select(*syn.CUSTOMER_FIELDS),
        "transactions": syn.inject_transaction_faults(moves, n).select(*syn.TRANSACTION_FIELDS),
    }


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("build")
    deliveries = {}
    for name, table in synthetic(spark).items():
        deliveries[name] = f"{root}/{name}.csv"
        write_csv(table, table.columns, deliveries[name])
    lake = Lake(spark, f"{root}/lake", prefix="build_")
    lake.deliveries = deliveries
    lake.details = run(lake, deliveries, key=KEY)
    return lake


def test_synthetic_data_does_not_depend_on_partitioning(spark):
    for name in ("customers", "transactions"):
        one, many = synthetic(spark, partitions=1)[name], synthetic(spark, partitions=7)[name]
        assert rows(one) == rows(many)
    sound = syn.transactions(spark.range(1, 1001), 1000, 200, 40)
    assert sound.filter("processing_region <> 'af-south-1'").count() == 40


def test_every_fault_is_found_and_nothing_else_but_cascades(spark, lake):
    q = lake.table("silver", "quarantine")
    assert EXPECTED <= {(r.dataset, r.record_key, r.rule) for r in q.collect()}
    expected = spark.createDataFrame(sorted(EXPECTED), "dataset string, record_key string, rule string")
    extra = assurance.unexpected_rejections(q, expected).collect()
    assert extra and {r.rule for r in extra} == {"parent_quarantined"}
    assert q.select("dataset", "record_key", "rule", "column_name").distinct().count() == q.count()


def test_faults_are_found_among_very_many(spark):
    found = quarantine(
        judge(synthetic(spark, 100_000, 20_000, 8), load_contracts()), load_contracts(), load_policy(GOVERNANCE / "residency.yml")
    ).filter("rule <> 'parent_quarantined'")
    expected = {t if t[1] != "T001000" else ("transactions", "T100000", t[2]) for t in EXPECTED}
    assert {(r.dataset, r.record_key, r.rule) for r in found.collect()} == expected


def test_invariants_hold(lake):
    contracts = load_contracts()
    silver = {n: lake.table("silver", n) for n in contracts}
    for name, contract in contracts.items():
        balance = assurance.record_balance(
            lake.table("bronze", name), silver[name], lake.table("silver", "quarantine"), contract
        ).first()
        assert balance.in_both == balance.lost == balance.invented == 0
        assert balance.raw_keys == {"customers": 200, "transactions": 999}[name]
        assert assurance.key_duplicates(silver[name], contract["primary_key"], name).first().duplicates == 0
    assert silver["customers"].count() == 196
    assert assurance.dangling_transactions(silver["transactions"], silver["customers"]).first().dangling == 0
    typed = assurance.typed_columns(silver["transactions"], "t", ["amount_zar", "txn_timestamp"]).collect()
    assert [(r.type_name, r.missing) for r in typed] == [("decimal(12,2)", 0), ("timestamp_ntz", 0)]
    assert dict(silver["customers"].dtypes)["signup_date"] == "date"


def test_no_personal_value_leaks(lake):
    contracts = load_contracts()
    leaks = assurance.pii_leaks(lake.table("silver", "customers"), lake.table("bronze", "customers"), contracts["customers"])
    assert {(r.column_name, r.in_silver, r.leaks) for r in leaks.collect()} == {
        ("first_name", False, 0), ("last_name", False, 0), ("sa_id_number", True, 0), ("email", True, 0), ("phone", True, 0),
    }
    bronze = {n: lake.table("bronze", n) for n in contracts}
    values, fixed = personal_values(bronze, contracts), wording(lake.spark, contracts)
    found = assurance.reason_leaks(lake.table("silver", "quarantine"), contracts, values, fixed).collect()
    assert {(r.leaks, r.key_leaks) for r in found} == {(0, 0)}
    raw = lake.table("bronze", "customers").filter("customer_id = 'C00001'").first().sa_id_number
    assert all(raw not in r.reason for r in lake.table("silver", "quarantine").collect())


PEOPLE = [  # key, first name, last name, e-mail, province
    ("C1", "Ann", "van der Merwe", "ann@example.com", "bob@example.com"),  # another's e-mail
    ("C2", "Bob", "Smith", "Bob@Example.com", "(Van der  MERWE)"),  # a name of several words
    ("C3", "Found", "Customers", "c@example.com", "Atlantis"),  # named like the wording
    ("cara@example.com", "Cara", "Lee", "cara@example.com", "Gauteng!"),  # an e-mail for a key
    ("C5", "Dan", "O'Brien", "d@example.com", "x O'Brien."),
    ("C6", "Eve", "Fox", "e@example.com", "Vander Merwe"),  # not a value: other words
]


def people(spark, contracts):
    schema = ", ".join(f"{spec['name']} string" for spec in contracts["customers"]["columns"])
    made = [(k, first, last, "8001015009087", mail, "+27821234567", where, "2024-01-01", "af-south-1") for k, first, last, mail, where in PEOPLE]
    customers = spark.createDataFrame(made, schema)
    moves = [("T1", "bob@example.com", "5", "ZAR", "m", "2024-01-01T00:00:00", "af-south-1")]
    return {
        "customers": customers,
        "transactions": spark.createDataFrame(moves, ", ".join(f"{s['name']} string" for s in contracts["transactions"]["columns"])),
    }


def test_personal_values_typed_into_other_columns_are_found_and_redacted(spark):
    contracts, policy = load_contracts(), load_policy(GOVERNANCE / "residency.yml")
    judged = judge(people(spark, contracts), contracts)
    values, fixed = personal_values(judged, contracts), wording(spark, contracts)
    raw = reasons(judged, contracts, policy)
    hidden = "row_" + hashlib.sha256(b"cara@example.com").hexdigest()[:32]
    before = {(r.column_name, r.leaks, r.key_leaks) for r in assurance.reason_leaks(raw, contracts, values, fixed).collect()}
    assert before == {("province", 3, 1), ("customer_id", 1, 0)}
    spilled = {(r.column_name, r.value_column, r.reasons) for r in assurance.spilled_values(raw, values, fixed).collect()}
    assert spilled == {("province", "email", 1), ("province", "last_name", 2), ("customer_id", "email", 1)}
    after = quarantine(judged, contracts, policy)
    plain = "allowed_values check failed (value redacted: PII)"
    said = {(r.record_key, r.reason) for r in after.collect()}
    assert {k for k, reason in said if reason == plain} == {"C1", "C2", "C5"}
    assert ("T1", "referential_integrity check failed (value redacted: PII)") in said
    assert {k for k, _ in said} == {"C1", "C2", "C3", hidden, "C5", "C6", "T1"}
    assert any("Atlantis" in reason for k, reason in said if k == "C3")
    assert any("Vander Merwe" in reason for k, reason in said if k == "C6")
    clean = assurance.reason_leaks(after, contracts, values, fixed).collect()
    assert {(r.leaks, r.key_leaks) for r in clean} == {(0, 0)}
    kept = silver_customers(judged["customers"], contracts["customers"], KEY)
    balance = assurance.record_balance(judged["customers"], kept, after, contracts["customers"]).first()
    assert (balance.raw_keys, balance.quarantine_only, balance.lost, balance.invented) == (6, 6, 0, 0)


def test_texts_say_values_word_by_word(spark):
    texts = ["a 'b c' d", "abc", "b, c!", "c b", "", "b  c b c", None, "x" * 5000 + " b c"]
    values = [("b c", 2), ("abc", 1), ("c b c", 3), ("nothing here", 2)]
    found = said_values(
        spark.createDataFrame([(t,) for t in texts], "text string").filter("text is not null"),
        spark.createDataFrame(values, "value string, size int"),
        spark.createDataFrame([("abc is fixed",)], "text string"),
    )
    assert rows(found) == {(texts[0], "b c"), ("b, c!", "b c"), ("b  c b c", "b c"), ("b  c b c", "c b c"), (texts[-1], "b c")}
    assert spark.range(1).select(words(F.lit("It's (here): a.b@c.de. [x]"))).first()[0] == ["it", "s", "here", "a.b@c.de", "x"]


def test_marts_reconcile(lake):
    transactions, customers = lake.table("silver", "transactions"), lake.table("silver", "customers")
    daily = assurance.reconcile_daily(lake.table("gold", "daily_revenue_by_province"), transactions).first()
    summary = assurance.reconcile_customers(lake.table("gold", "customer_transaction_summary"), transactions, customers).first()
    report = assurance.reconcile_transfers(lake.table("gold", "cross_border_transfer_report"), transactions).first()
    assert daily.reconciles and daily.mart_count > 0
    assert summary.mart_count == summary.mart_keys == summary.silver_count == 196
    assert summary.mart_amount == summary.silver_amount
    assert report.reconciles and report.mart_count > 0 and report.domestic_rows == report.unnamed_rows == 0


def test_a_second_run_changes_nothing_and_the_audit_grows(lake):
    tables = [t for t in lake.tables("bronze", "silver", "gold")]
    before = {t: lake.table(*t) for t in tables}
    prints = {t: tuple(assurance.fingerprint(f, "x").first()) for t, f in before.items()}
    events = lake.table("ops", "audit_log").count()
    assert run(lake, lake.deliveries, key=KEY) == lake.details
    assert lake.tables("bronze", "silver", "gold") == tables and len(tables) == 9
    for t in tables:
        assert tuple(assurance.fingerprint(lake.table(*t), "x").first()) == prints[t], t
        assert assurance.changed_rows(before[t], lake.table(*t)).count() == 0
    log = lake.table("ops", "audit_log").collect()
    assert len(log) == events + 1 and {r.event for r in log} == {"build_silver"}
    assert log[-1].details == lake.details and lake.details["silver_customers"] == 196


def test_the_build_needs_a_key(lake, monkeypatch):
    monkeypatch.delenv("TOKENIZATION_KEY", raising=False)
    with pytest.raises(RuntimeError):
        run(lake, {})


def test_shuffles_grow_with_the_input_of_each_run(spark, lake, monkeypatch):
    paths = [path.replace("customers", "c*") for path in lake.deliveries.values()]
    with pipeline.sized_shuffles(spark, paths) as usual:
        assert usual == 4
    monkeypatch.setattr(pipeline, "SHUFFLE_BYTES", 1000)
    with pipeline.sized_shuffles(spark, paths) as many:
        assert many > 50 and spark.conf.get(pipeline.INITIAL_PARTITIONS) == str(many)
    with pipeline.sized_shuffles(spark, paths[:1]) as fewer:
        assert usual < fewer < many
    assert spark.conf.get(pipeline.INITIAL_PARTITIONS, None) is None
    spark.conf.set(pipeline.INITIAL_PARTITIONS, "9")
    try:
        with pipeline.sized_shuffles(spark, paths) as own:
            assert own == 9
        assert spark.conf.get(pipeline.INITIAL_PARTITIONS) == "9"
    finally:
        spark.conf.unset(pipeline.INITIAL_PARTITIONS)


def test_no_raw_data_stays_in_staging(lake):
    assert lake.tables("staging") == [] and lake._folders(f"{lake.root}/staging") == []


def test_the_script_runs_from_a_zip(tmp_path):
    """Generate, build and publish in sessions of their own, with the package in a zip."""
    import os
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    top = Path(__file__).resolve().parents[1]
    (tmp_path / "src").mkdir()
    skip = shutil.ignore_patterns("__pycache__", "llm")
    shutil.copytree(top / "borderlake", tmp_path / "src/borderlake", ignore=skip)
    package = shutil.make_archive(str(tmp_path / "borderlake"), "zip", tmp_path / "src")
    shutil.copy(top / "lakehouse.py", tmp_path / "lakehouse.py")
    options = "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2"
    env = {**os.environ, "TOKENIZATION_KEY": KEY, "PYTHONPATH": package, "PYSPARK_SUBMIT_ARGS": f"{options} pyspark-shell"}

    def start(*words):
        command = [sys.executable, str(tmp_path / "lakehouse.py"), *words]
        return subprocess.run(command, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300, check=True).stdout

    start("generate", f"{tmp_path}/in", "--transactions", "300", "--customers", "40", "--crossings", "12")
    governance = shutil.copytree(top / "borderlake/governance", tmp_path / "rules")
    out = start("build", f"{tmp_path}/lake", f"{tmp_path}/in/customers.csv", f"{tmp_path}/in/transactions.csv")
    again = start(
        "build", f"{tmp_path}/lake", f"{tmp_path}/in/customers.csv", f"{tmp_path}/in/transactions.csv", "--governance", str(governance)
    )
    assert "'silver_customers': 36" in out and "'silver_customers': 36" in again
    start("publish", f"{tmp_path}/lake", f"{tmp_path}/site")
    (site,) = (p for p in (tmp_path / "site").iterdir() if p.is_dir())
    assert (site / "tables.json").exists() and (site / "gold.cross_border_transfer_report.parquet").exists()
    assert '"settings"' in "".join(p.read_text() for p in (site / "payload.json").glob("*.json"))


def build(spark, tables):
    contracts, policy = load_contracts(), load_policy(GOVERNANCE / "residency.yml")
    judged = judge(tables, contracts)
    return (
        quarantine(judged, contracts, policy),
        silver_customers(judged["customers"], contracts["customers"], KEY),
        silver_transactions(judged["transactions"], contracts["transactions"], policy),
    )


def test_an_unknown_region_is_blocked(spark):
    tables = synthetic(spark)
    moved = F.when(F.col("transaction_id") == "T000500", "ap-south-1").otherwise(F.col("processing_region"))
    tables["transactions"] = tables["transactions"].withColumn("processing_region", moved)
    owner = tables["transactions"].filter("transaction_id = 'T000500'").first().customer_id
    q, _, kept = build(spark, tables)
    rules = {r.rule for r in q.filter("record_key = 'T000500'").collect()}
    assert rules - {"parent_quarantined"} == {"residency_blocked"} and (owner > "C00004") == (len(rules) == 1)
    assert kept.filter("transaction_id = 'T000500'").count() == 0


@pytest.mark.parametrize("partitions", ["13"])
def test_results_do_not_depend_on_the_number_of_partitions(spark, partitions):
    tables = synthetic(spark)
    expected = [tuple(assurance.fingerprint(f, "x").first()) for f in build(spark, tables)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert [tuple(assurance.fingerprint(f, "x").first()) for f in build(spark, tables)] == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_transfers_come_in_pages_in_order_of_time(spark, lake):
    customers, transactions = lake.table("silver", "customers"), lake.table("silver", "transactions")
    order = {r.transaction_id: (r.txn_timestamp, r.transaction_id) for r in transfer_rows(transactions).collect()}
    whole = subject_transfers(customers, transactions).collect()
    assert {r.page for r in whole} == {0} and all(len(r.stamps) == r.transfer_count for r in whole)
    for size in (1, 2, 3):
        pages = defaultdict(list)
        for r in sorted(subject_transfers(customers, transactions, page_size=size).collect(), key=lambda r: r.page):
            pages[r.customer_id].append([s.transaction_id for s in r.stamps])
        for found in pages.values():
            assert all(len(page) == size for page in found[:-1]) and 1 <= len(found[-1]) <= size
            flat = [i for page in found for i in page]
            assert flat == sorted(flat, key=order.get)
        assert sorted(i for found in pages.values() for page in found for i in page) == sorted(order)


def test_a_preview_is_short(lake):
    assert preview(lake.table("silver", "transactions"), "transaction_id").count() == 50
    assert preview(lake.table("silver", "transactions"), "transaction_id", rows=700).count() == 700
