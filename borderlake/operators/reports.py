"""Consumer reports over silver and gold. Only masked values are read."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from borderlake.functions.residency import REGION_NAMES, region_name
from borderlake.operators.gold import TOTAL, crossed
from borderlake.operators.set_checks import union
from borderlake.sources.lake import stored

# A subject's transfers are nested in pages of this many, so that no row and no
# task ever holds an unbounded group. Nearly every subject has one page.
TRANSFERS_PER_PAGE = 500
PREVIEW_ROWS = 50

# Columns of a transfer.
TRANSFER = (
    "transaction_id",
    "customer_id",
    "processing_region",
    "residency_status",
    "amount_zar",
    "merchant",
    "txn_timestamp",
)
SUBJECT = ("customer_id", "sa_id_number", "email", "phone", "province", "signup_date", "home_region")


def activity(transactions: DataFrame) -> DataFrame:
    """What reports on subjects need, from one scan: a row for each crossing, and one for each
    customer and home route, with the number of transactions ``n``.

    One aggregate does both, as its key holds the columns of a transaction where it crossed
    and NULLs where it did not; domestic transactions shrink before the shuffle.
    """
    own = [c for c in TRANSFER if c not in ("customer_id", "processing_region")]
    keys = [F.when(crossed(), F.col(c)).alias(c) for c in own]
    return transactions.groupBy("customer_id", "home_region", "processing_region", *keys).agg(F.count("*").alias("n"))


def crossing_counts(transactions: DataFrame) -> DataFrame:
    """Per customer with at least one crossing: domestic transactions, crossings, regions crossed to."""
    return _crossings(transactions.withColumn("n", F.lit(1)))


def _crossings(moves: DataFrame) -> DataFrame:
    routes = moves.groupBy("customer_id", "home_region", "processing_region").agg(F.sum("n").alias("n"))
    return (
        routes.groupBy("customer_id")
        .agg(
            F.sum(F.when(crossed(), 0).otherwise(F.col("n"))).alias("domestic_txns"),
            F.sum(F.when(crossed(), F.col("n")).otherwise(0)).alias("transfer_count"),
            F.count_if(crossed()).alias("region_count"),
        )
        .filter("transfer_count > 0")
    )


def _subjects(customers: DataFrame, counts: DataFrame) -> DataFrame:
    people = customers.withColumn("signup_date", F.col("signup_date").cast("string")).select(*SUBJECT)
    return people.join(counts, "customer_id")


def stamped_subjects(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Customers with at least one crossing, and how often they stayed at home."""
    return _subjects(customers, crossing_counts(transactions)).select(*SUBJECT, "domestic_txns")


def transfer_rows(transactions: DataFrame) -> DataFrame:
    return transactions.filter(crossed()).select(
        "transaction_id",
        "customer_id",
        "processing_region",
        "residency_status",
        F.col("amount_zar").cast("double").alias("amount_zar"),
        "merchant",
        F.col("txn_timestamp").cast("date").cast("string").alias("txn_date"),
        "txn_timestamp",
    )


def transfer_stamps(transactions: DataFrame) -> DataFrame:
    """Every crossing. Readers order them by txn_timestamp; the id settles equal times."""
    return transfer_rows(transactions)


def time_pages(rows: DataFrame, page_size: int) -> DataFrame:
    """Number each customer's rows in order of time, ``page_size`` to a page, from 0.

    Rows before an hour come from running sums over the hours of a customer, and
    only the rows of one hour are ranked together, so that no task ever orders
    all rows of a busy customer.
    """
    hourly = rows.withColumn("_hour", F.date_trunc("HOUR", "txn_timestamp"))
    earlier = Window.partitionBy("customer_id").orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("customer_id", "_hour").orderBy("txn_timestamp", "transaction_id")
    hours = hourly.groupBy("customer_id", "_hour").agg(F.count("*").alias("_n"))
    before = hours.select("customer_id", "_hour", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.row_number().over(within) - 1
    ranked = hourly.join(before, ["customer_id", "_hour"]).withColumn("page", F.floor(place / page_size))
    return ranked.drop("_hour", "_before")


def subject_transfers(
    customers: DataFrame, transactions: DataFrame, page_size: int = TRANSFERS_PER_PAGE
) -> DataFrame:
    """Subjects with their transfers nested, one row per subject and page.

    Transfers are in order of time, within a page and from page to page. They are
    nested before the subject is joined, so its columns are not shuffled with
    every transfer. Readers order subjects by region_count and transfer_count,
    the busiest first, then by id and page. The transactions are scanned once.
    """
    return _subject_pages(customers, stored(activity(transactions), "activity"), page_size)


def _subject_pages(customers: DataFrame, moves: DataFrame, page_size: int) -> DataFrame:
    transfer = F.struct(
        "txn_timestamp",
        "transaction_id",
        "processing_region",
        "residency_status",
        "amount_zar",
        "merchant",
        "txn_date",
    )
    pages = time_pages(transfer_rows(moves), page_size).groupBy("customer_id", "page")
    nested = pages.agg(F.sort_array(F.collect_list(transfer)).alias("stamps"))
    plain = F.transform("stamps", lambda s: s.dropFields("txn_timestamp")).alias("stamps")
    subjects = _subjects(customers, _crossings(moves))
    return subjects.join(nested.select("customer_id", "page", plain), "customer_id").select(
        *SUBJECT, "domestic_txns", "region_count", "transfer_count", "page", "stamps"
    )


def _totals(report: DataFrame) -> DataFrame:
    return report.agg(
        F.sum("transfer_count").alias("transfers"),
        F.sum("amount_zar").cast(TOTAL).alias("amount_zar"),
        F.count_distinct("transfer_month").alias("months"),
    )


def transfer_totals(report: DataFrame) -> DataFrame:
    return _totals(report).withColumn("amount_zar", F.col("amount_zar").cast("double"))


def blocked_count(quarantine: DataFrame) -> DataFrame:
    return quarantine.filter(F.col("rule") == "residency_blocked").agg(F.count("*").alias("blocked"))


def customer_pii(inventory: DataFrame) -> DataFrame:
    return inventory.filter(F.col("dataset") == "customers").select("column_name", "mask_strategy")


def with_region_names(table: DataFrame, column: str = "processing_region") -> DataFrame:
    return table.withColumn("region_name", region_name(F.col(column)))


def view_payload(
    spark: SparkSession,
    customers: DataFrame,
    transactions: DataFrame,
    report: DataFrame,
    quarantine: DataFrame,
    inventory: DataFrame,
    policy: dict,
    page_size: int = TRANSFERS_PER_PAGE,
) -> DataFrame:
    """Everything a page about transfers shows, as JSON: one row per subject and
    page, per personal column, and one each for totals and settings.

    Safe to place inside an HTML script element. Counts, totals and pages come from one scan
    of the transactions.
    """
    moves = stored(activity(transactions), "activity")
    nulls = {"ignoreNullFields": "false"}

    def part(name: str, frame: DataFrame) -> DataFrame:
        body = F.to_json(F.struct(*frame.columns), nulls)
        return frame.select(F.lit(name).alias("part"), F.replace(body, F.lit("</"), F.lit("<\\/")).alias("body"))

    totals = _totals(report).select(
        "*",
        moves.filter(crossed()).agg(F.count_distinct("customer_id")).scalar().alias("subjects"),
        blocked_count(quarantine).scalar().alias("blocked"),
    )
    settings = {
        "home_region": policy.get("home_region"),
        "flagged_regions": policy.get("flagged_regions") or [],
        "region_names": REGION_NAMES,
    }
    return union(
        [
            part("subject", _subject_pages(customers, moves, page_size)),
            part("totals", totals),
            part("pii", customer_pii(inventory)),
            spark.createDataFrame([("settings", json.dumps(settings))], "part string, body string"),
        ]
    )


def report_overview(report: DataFrame) -> DataFrame:
    return report.select(
        "transfer_month",
        "processing_region",
        "transfer_count",
        "data_subjects_affected",
        "amount_zar",
        "pct_of_month_txns",
    ).orderBy("transfer_month", "processing_region")


def transfers_by_region(report: DataFrame) -> DataFrame:
    return (
        report.groupBy("processing_region")
        .agg(
            F.sum("transfer_count").alias("transfers"),
            F.sum("data_subjects_affected").alias("subject_months"),
            F.round(F.sum("amount_zar"), 2).cast(TOTAL).alias("amount_zar"),
        )
        .orderBy(F.desc("transfers"), "processing_region")
    )


def masked_sample(customers: DataFrame, rows: int = 10) -> DataFrame:
    """A few masked customers to look at; the lowest ids, so that it is repeatable."""
    return customers.select("customer_id", "sa_id_number", "email", "phone", "province").orderBy(
        "customer_id"
    ).limit(rows)


def quarantine_by_rule(quarantine: DataFrame) -> DataFrame:
    return (
        quarantine.groupBy("source_table", "rule")
        .agg(F.count("*").alias("rows_quarantined"))
        .orderBy(F.desc("rows_quarantined"), "source_table", "rule")
    )


def revenue_by_province(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("province")
        .agg(
            F.sum("transaction_count").alias("transactions"),
            F.round(F.sum("revenue_zar"), 2).cast(TOTAL).alias("revenue_zar"),
        )
        .orderBy(F.desc("revenue_zar"), "province")
    )


def preview(table: DataFrame, *order: str, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of a table."""
    return table.orderBy(*[F.asc_nulls_last(c) for c in order]).limit(rows)
