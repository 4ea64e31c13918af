"""The registered queries: every operator over the shared test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DecimalType, DoubleType, TimestampNTZType

from borderlake.functions.mask import mask
from borderlake.functions.residency import classify_transfer
from borderlake.functions.text import cell
from borderlake.operators import assurance, digests, gold, reports
from borderlake.operators.contracts import LINEAGE, normalise_keys, validate
from borderlake.operators.judge import (
    HOME,
    OTHER_HOME,
    contract_violations,
    judge,
    parent_quarantined,
    quarantine,
    reasons,
    residency_blocked,
    wording,
)
from borderlake.operators.leaks import personal_values
from borderlake.operators.set_checks import (
    collapse_copies,
    conflicting_keys,
    duplicate_keys,
    orphans,
    set_check_violations,
    union,
)
from borderlake.plans.pipeline import ingest, transform
from borderlake.sources import synthetic
from borderlake.sources.delivery import read_csv
from borderlake.sources.lake import shared_folder
from borderlake.sources.publish import open_published, publish, published_folder
from borderlake.verification import derived
from borderlake.verification.staged import Staged

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}

# Transfers to a page, so few that many subjects have several.
PAGE = 2

LOADED_AT = "2026-01-01T00:00:00+00:00"

EVENTS = {
    "dataset": "events",
    "primary_key": "event_id",
    "columns": [
        {"name": "event_id", "type": "int", "nullable": False},
        {"name": "user_id", "type": "integer", "nullable": False},
        {"name": "event_type", "type": "string", "allowed_values": ["click", "purchase", "signup", "view"]},
        {"name": "value", "type": "float", "min": 100},
        {"name": "channel", "type": "string", "nullable": True, "allowed_values": False},
    ],
}


def edge(frame: DataFrame) -> DataFrame:
    """Plain types for comparison: money as double, dates and times as text, lists as JSON."""

    def plain(field):
        col = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, (DateType, TimestampNTZType)):
            col = col.cast("string")
        elif isinstance(field.dataType, ArrayType):
            col = F.to_json(col, {"ignoreNullFields": "false"})
        return col.alias(field.name)

    return frame.select(*[plain(f) for f in frame.schema.fields])


def query(fn: Callable[[Staged], DataFrame]) -> Callable[[Staged], DataFrame]:
    """Register a query under its function's name."""
    REGISTERED[fn.__name__.rstrip("_")] = lambda spark, sf_dir: edge(fn(Staged(spark, sf_dir)))
    return fn


# --- sources and sinks -------------------------------------------------------------


def checksum(name: str, table: DataFrame, label: str = "table_name") -> DataFrame:
    """Rows of a table and an order-free sum over their contents, lineage left out."""

    def text(field) -> F.Column:
        kind = "decimal(38,2)" if isinstance(field.dataType, (DecimalType, DoubleType)) else "string"
        return F.coalesce(F.col(field.name).cast(kind).cast("string"), F.lit(""))

    fields = sorted((f for f in table.schema.fields if f.name not in LINEAGE), key=lambda f: f.name)
    digest = F.substring(F.md5(F.concat_ws("|", *[text(f) for f in fields])), 1, 15)
    total = F.sum(F.conv(digest, 16, 10).cast("decimal(38,0)")) % 1_000_000_000_000_000
    rows = F.count("*").alias("row_count")
    return table.agg(rows, total.cast("bigint").alias("content_sum")).select(F.lit(name).alias(label), "*")


@query
def ingest_bronze(s: Staged) -> DataFrame:
    """CSV out, CSV in: every record as one text, and whether its lineage is there."""
    parts = []
    for name, path in s.new_delivery().items():
        rows = read_csv(s.spark, path, LOADED_AT)
        record = F.concat_ws("|", *[c for c in rows.columns if c not in LINEAGE])
        lineage = F.col("_source_file").endswith(".csv") & (F.col("_ingested_at") == LOADED_AT)
        parts.append(rows.select(F.lit(name).alias("dataset"), record.alias("record"), lineage.alias("has_lineage")))
    return union(parts)


@query
def ingest_counts(s: Staged) -> DataFrame:
    counts = ingest(s.new_lake(), s.new_delivery())
    return s.spark.createDataFrame(sorted(counts.items()), "dataset string, row_count bigint")


@query
def publish_layer(s: Staged) -> DataFrame:
    """Contents of every published file."""
    target = shared_folder(s.spark, "published")
    files = [(f"{r.schema}.{r.table}", r.file) for r in publish(s.lake, target).collect()]
    folder = published_folder(s.spark, target)
    return union([checksum(name, s.spark.read.parquet(f"{folder}/{file}")) for name, file in files])


@query
def publish_manifest(s: Staged) -> DataFrame:
    manifest = publish(s.lake, shared_folder(s.spark, "published"))
    names = F.transform("columns", lambda c: F.concat(c["name"], F.lit(":"), c["type"]))
    return manifest.select(
        F.col("schema").alias("table_schema"),
        F.col("table").alias("table_name"),
        "file",
        F.col("rows").alias("row_count"),
        F.array_join(names, ",").alias("column_list"),
    )


@query
def published_views(s: Staged) -> DataFrame:
    target = shared_folder(s.spark, "published")
    publish(s.lake, target)
    return union([checksum(name, view, "view_name") for name, view in open_published(s.spark, target).items()])


def _ids(s: Staged, table: str, key: str) -> DataFrame:
    """One id per row of a source table, from 1."""
    return s.source(table).select((F.col(key) + 1).alias("id"))


def _synthetic(s: Staged) -> tuple[DataFrame, DataFrame, int]:
    n_customers, n = s.source("customer").count(), s.source("orders").count()
    people = synthetic.customers(_ids(s, "customer", "c_custkey"))
    moves = synthetic.transactions(_ids(s, "orders", "o_orderkey"), n, n_customers, n // 25)
    return people, moves, n


@query
def synthetic_customers(s: Staged) -> DataFrame:
    return _synthetic(s)[0].select(*synthetic.CUSTOMER_FIELDS)


@query
def synthetic_transactions(s: Staged) -> DataFrame:
    return _synthetic(s)[1].select(*synthetic.TRANSACTION_FIELDS)


@query
def inject_faults(s: Staged) -> DataFrame:
    """Put the nine known faults in, and see what the contracts find."""
    people, moves, n = _synthetic(s)
    folder = shared_folder(s.spark, "synthetic")
    tables = {
        "customers": synthetic.inject_customer_faults(people).select(*synthetic.CUSTOMER_FIELDS),
        "transactions": synthetic.inject_transaction_faults(moves, n).select(
            *synthetic.TRANSACTION_FIELDS
        ),
    }
    for name, table in tables.items():
        table.write.parquet(f"{folder}/{name}")
    stored = {name: s.spark.read.parquet(f"{folder}/{name}") for name in tables}
    return contract_violations(judge(stored, s.contracts), s.contracts).select("dataset", "record_key", "rule")


# --- contract rules ------------------------------------------------------------------


@query
def validate_customers(s: Staged) -> DataFrame:
    return validate(s.bronze["customers"], s.contracts["customers"])


@query
def validate_transactions(s: Staged) -> DataFrame:
    return validate(s.bronze["transactions"], s.contracts["transactions"])


@query
def validate_events(s: Staged) -> DataFrame:
    """A contract of whole and floating numbers, over the events."""
    k = F.col("event_id")
    rows = s.source("events").select(
        k.cast("string").alias("event_id"),
        F.when(k % 17 == 3, F.concat(F.lit("0x"), F.col("user_id").cast("string")))
        .when(k % 17 == 4, F.concat(F.lit("+1_0"), F.col("user_id").cast("string")))
        .otherwise(F.col("user_id").cast("string"))
        .alias("user_id"),
        "event_type",
        F.when(k % 19 == 5, F.lit("NaN"))
        .when(k % 19 == 6, F.lit("-inf"))
        .when(k % 19 == 7, F.lit("1.0d"))
        .otherwise(F.col("value").cast("string"))
        .alias("value"),
    )
    return validate(rows, EVENTS)


def _one_rule(rule: str) -> None:
    """Register one rule by itself, over both deliveries, values redacted."""

    def only(contract: dict) -> dict:
        keep = {"name", "nullable", "pii", rule} - ({"nullable"} if rule != "not_null" else set())
        # The silver type check of amounts depends on whether min reports them.
        keep |= {"min"} if rule == "type" else set()
        columns = [{k: v for k, v in spec.items() if k in keep} for spec in contract["columns"]]
        return {**contract, "columns": columns}

    def found(s: Staged) -> DataFrame:
        parts = [
            validate(s.bronze[name], only(contract), redact=True)
            for name, contract in s.contracts.items()
            if any(rule in spec or rule == "not_null" for spec in contract["columns"])
        ]
        return union(parts).filter(F.col("rule") == rule)

    found.__name__ = f"rule_{rule}"
    query(found)


for _rule in ("not_null", "type", "allowed_values", "sa_id", "email", "phone", "min"):
    _one_rule(_rule)


@query
def contract_violations_(s: Staged) -> DataFrame:
    return contract_violations(s.judged, s.contracts)


@query
def redacted_reasons(s: Staged) -> DataFrame:
    found = validate(s.bronze["customers"], s.contracts["customers"], redact=True)
    return found.groupBy("column_name", "rule", "reason").agg(F.count("*").alias("violations"))


# --- set checks ------------------------------------------------------------------------


@query
def dup_customer_ids(s: Staged) -> DataFrame:
    return duplicate_keys(s.bronze["customers"], s.contracts["customers"])


@query
def dup_transaction_ids(s: Staged) -> DataFrame:
    return duplicate_keys(s.bronze["transactions"], s.contracts["transactions"])


@query
def dup_lineitems(s: Staged) -> DataFrame:
    """Order lines whose order and line number name several different lines."""
    found = conflicting_keys(collapse_copies(s.source("lineitem")), "l_orderkey", "l_linenumber")
    return found.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"), "n")


@query
def orphan_transactions(s: Staged) -> DataFrame:
    clean = {name: normalise_keys(table, s.contracts[name]) for name, table in s.bronze.items()}
    children = clean["transactions"].select("transaction_id", "customer_id")
    return orphans(children, "customer_id", clean["customers"], "customer_id")


@query
def set_check_violations_(s: Staged) -> DataFrame:
    return set_check_violations(s.bronze, s.contracts)


# --- governance ------------------------------------------------------------------------


def _masked(s: Staged, column: str, strategy: str) -> DataFrame:
    text = F.nullif(F.lower(cell(column)), F.lit(""))
    rows = collapse_copies(normalise_keys(s.bronze["customers"], s.contracts["customers"]))
    return rows.select("customer_id", mask(text, strategy, s.key).alias(column))


@query
def mask_hash(s: Staged) -> DataFrame:
    return _masked(s, "email", "hash")


@query
def mask_tokenise(s: Staged) -> DataFrame:
    return _masked(s, "sa_id_number", "tokenise")


@query
def mask_partial(s: Staged) -> DataFrame:
    return _masked(s, "phone", "partial")


def _inventory(s: Staged) -> DataFrame:
    return assurance.inventory_in_use(s.bronze, s.inventory, s.contracts)


@query
def pii_inventory_(s: Staged) -> DataFrame:
    return _inventory(s)


@query
def classify_transfer_(s: Staged) -> DataFrame:
    region = F.col("processing_region")
    return s.judged["transactions"].select(
        "transaction_id",
        F.col(HOME).alias("home_region"),
        F.col(OTHER_HOME).alias("other_home"),
        region,
        classify_transfer(F.col(HOME), region, s.policy).alias("verdict"),
        classify_transfer(F.col(OTHER_HOME), region, s.policy).alias("other_verdict"),
    )


@query
def audit_build_silver(s: Staged) -> DataFrame:
    entry = s.lake.table("ops", "audit_log")
    names = (
        "contract_violations",
        "quarantined_records",
        "silver_customers",
        "silver_transactions",
        "cross_border_transactions",
    )
    return entry.select("event", *[F.col("details")[n].alias(n) for n in names])


# --- quarantine and silver ---------------------------------------------------------------


@query
def parent_quarantined_(s: Staged) -> DataFrame:
    return parent_quarantined(s.judged["transactions"], s.contracts["transactions"])


@query
def residency_blocked_(s: Staged) -> DataFrame:
    return residency_blocked(s.judged["transactions"], s.contracts["transactions"], s.policy)


@query
def quarantine_(s: Staged) -> DataFrame:
    return quarantine(s.judged, s.contracts, s.policy)


@query
def dedupe_exact(s: Staged) -> DataFrame:
    return collapse_copies(s.bronze["transactions"])


@query
def dedupe_customers(s: Staged) -> DataFrame:
    return collapse_copies(s.bronze["customers"])


@query
def silver_customers(s: Staged) -> DataFrame:
    return s.customers


@query
def silver_transactions(s: Staged) -> DataFrame:
    return s.transactions


@query
def build_silver(s: Staged) -> DataFrame:
    """The whole build from CSV, anew; contents of the silver tables."""
    lake = s.new_lake()
    ingest(lake, s.new_delivery())
    transform(lake, s.contracts, s.policy, s.key)
    return union([checksum(name, lake.table(layer, name)) for layer, name in lake.tables("silver")])


@query
def build_gold(s: Staged) -> DataFrame:
    """The marts from the stored silver tables, stored in turn; their contents."""
    silver = {name: s.lake.table("silver", name) for name in ("customers", "transactions", "pii_inventory")}
    folder = shared_folder(s.spark, "marts")
    found = []
    for name, mart in gold.build_gold(silver).items():
        mart.write.parquet(f"{folder}/{name}")
        found.append(checksum(name, s.spark.read.parquet(f"{folder}/{name}")))
    return union(found)


# --- marts ---------------------------------------------------------------------------------


def _daily(s: Staged) -> DataFrame:
    return gold.daily_revenue_by_province(s.transactions, s.customers)


def _summary(s: Staged) -> DataFrame:
    return gold.customer_transaction_summary(s.transactions, s.customers)


def _report(s: Staged) -> DataFrame:
    return gold.cross_border_transfer_report(s.transactions, s.inventory)


@query
def daily_revenue_by_province(s: Staged) -> DataFrame:
    return _daily(s)


@query
def customer_transaction_summary(s: Staged) -> DataFrame:
    return _summary(s)


@query
def favourite_merchant(s: Staged) -> DataFrame:
    return gold.favourite_merchant(s.transactions)


@query
def customer_totals(s: Staged) -> DataFrame:
    return gold.customer_totals(s.transactions)


@query
def cross_border_transfer_report(s: Staged) -> DataFrame:
    return _report(s)


@query
def monthly_volume(s: Staged) -> DataFrame:
    return gold.monthly_volume(s.transactions)


@query
def pii_categories(s: Staged) -> DataFrame:
    return gold.pii_categories(s.lake.table("silver", "pii_inventory"))


# --- reports ---------------------------------------------------------------------------------


@query
def stamped_subjects(s: Staged) -> DataFrame:
    return reports.stamped_subjects(s.customers, s.transactions)


@query
def transfer_stamps(s: Staged) -> DataFrame:
    return reports.transfer_stamps(s.transactions)


@query
def subject_transfers(s: Staged) -> DataFrame:
    return reports.subject_transfers(s.customers, s.transactions, PAGE)


@query
def transfer_totals(s: Staged) -> DataFrame:
    return reports.transfer_totals(_report(s))


@query
def blocked_count(s: Staged) -> DataFrame:
    return reports.blocked_count(s.quarantine)


@query
def customer_pii(s: Staged) -> DataFrame:
    return reports.customer_pii(s.lake.table("silver", "pii_inventory"))


@query
def subject_json(s: Staged) -> DataFrame:
    return reports.view_payload(
        s.spark, s.customers, s.transactions, _report(s), s.quarantine, s.inventory, s.policy, PAGE
    )


@query
def region_names(s: Staged) -> DataFrame:
    """Regions of all judged transactions, blocked ones too, by display name."""
    regions = s.judged["transactions"].groupBy("processing_region")
    return reports.with_region_names(regions.agg(F.count("*").alias("n")))


@query
def q_report(s: Staged) -> DataFrame:
    return reports.report_overview(_report(s))


@query
def q_transfers_by_region(s: Staged) -> DataFrame:
    return reports.transfers_by_region(_report(s))


@query
def q_masked_sample(s: Staged) -> DataFrame:
    return reports.masked_sample(s.customers)


@query
def q_quarantine_by_rule(s: Staged) -> DataFrame:
    return reports.quarantine_by_rule(s.quarantine)


@query
def q_revenue_by_province(s: Staged) -> DataFrame:
    return reports.revenue_by_province(_daily(s))


@query
def preview(s: Staged) -> DataFrame:
    return reports.preview(s.transactions, "transaction_id")


# --- assurance ---------------------------------------------------------------------------------


@query
def no_record_lost(s: Staged) -> DataFrame:
    bronze, rejected = s.bronze, s.quarantine
    silver = {"customers": s.customers, "transactions": s.transactions}
    return union(
        [
            assurance.record_balance(bronze[name], silver[name], rejected, contract)
            for name, contract in s.contracts.items()
        ]
    )


@query
def silver_keys_unique(s: Staged) -> DataFrame:
    return union(
        [
            assurance.key_duplicates(s.customers, "customer_id", "customers"),
            assurance.key_duplicates(s.transactions, "transaction_id", "transactions"),
        ]
    )


@query
def silver_ref_integrity(s: Staged) -> DataFrame:
    return assurance.dangling_transactions(s.transactions, s.customers)


@query
def silver_typed(s: Staged) -> DataFrame:
    return union(
        [
            assurance.typed_columns(table, name, [c for c in table.columns if c not in LINEAGE])
            for name, table in (("customers", s.customers), ("transactions", s.transactions))
        ]
    )


@query
def pii_leak(s: Staged) -> DataFrame:
    return assurance.pii_leaks(s.customers, s.bronze["customers"], s.contracts["customers"])


@query
def reason_leak(s: Staged) -> DataFrame:
    """The published reasons: none may say a personal value."""
    values, fixed = personal_values(s.bronze, s.contracts), wording(s.spark, s.contracts)
    return assurance.reason_leaks(s.quarantine, s.contracts, values, fixed)


@query
def spilled_values(s: Staged) -> DataFrame:
    """Reasons before redaction: the personal values typed into other columns."""
    values, fixed = personal_values(s.bronze, s.contracts), wording(s.spark, s.contracts)
    return assurance.spilled_values(reasons(s.judged, s.contracts, s.policy), values, fixed)


@query
def recon_daily(s: Staged) -> DataFrame:
    return assurance.reconcile_daily(_daily(s), s.transactions)


@query
def recon_customer(s: Staged) -> DataFrame:
    return assurance.reconcile_customers(_summary(s), s.transactions, s.customers)


@query
def recon_cross_border(s: Staged) -> DataFrame:
    return assurance.reconcile_transfers(_report(s), s.transactions)


@query
def table_fingerprint(s: Staged) -> DataFrame:
    """Build twice into a lake of its own; no table may change."""
    lake, csv = s.new_lake(), s.new_delivery()

    def prints() -> dict:
        ingest(lake, csv)
        transform(lake, s.contracts, s.policy, s.key)
        tables = lake.tables("bronze", "silver", "gold")
        rows = union([assurance.fingerprint(lake.table(*t), ".".join(t)) for t in tables]).collect()
        return {r["table_name"]: (r["row_count"], r["digest"]) for r in rows}

    before, after = prints(), prints()
    rows = [(name, seen[0], after.get(name) == seen) for name, seen in before.items()]
    return s.spark.createDataFrame(rows, "table_name string, row_count bigint, unchanged boolean")


def _one_changed(s: Staged) -> DataFrame:
    """The raw transactions with another merchant in one record."""
    raw = s.bronze["transactions"]
    first = raw.agg(F.min("transaction_id")).scalar()
    merchant = F.when(F.col("transaction_id") == first, F.lit("another")).otherwise(F.col("merchant"))
    return raw.withColumn("merchant", merchant)


@query
def digest_tree_(s: Staged) -> DataFrame:
    return digests.digest_tree(digests.digest_leaves(s.bronze["transactions"], "transaction_id"))


@query
def differing_ranges(s: Staged) -> DataFrame:
    """One record differs: the nodes on the way from the root to its leaf, from digests only."""
    trees = [
        digests.digest_tree(digests.digest_leaves(table, "transaction_id"))
        for table in (s.bronze["transactions"], _one_changed(s))
    ]
    return digests.differing_nodes(*trees)


@query
def located_changes(s: Staged) -> DataFrame:
    return digests.changed_rows(s.bronze["transactions"], _one_changed(s), "transaction_id")


@query
def quarantine_extras(s: Staged) -> DataFrame:
    """Rejections beyond the faults put in: only consequences of them."""
    extra = assurance.unexpected_rejections(s.quarantine, derived.expected_faults(s.spark, s.sf_dir))
    return extra.groupBy("dataset", "rule").agg(F.count("*").alias("records"))
