"""Gold marts over the silver tables.

Every mart first aggregates per customer (and day, merchant or route), so a
customer with very many transactions shrinks before anything is joined or
counted, and distinct customers become a plain count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

TOTAL = "decimal(38,2)"


def average(total: Column, count: Column) -> Column:
    """Mean of exact money as a double, rounded to cents.

    The sum is exact, so the mean does not depend on the order of the rows; it
    is divided and rounded in double arithmetic, as ``ROUND(AVG(x), 2)`` is in
    an engine whose average of decimals is a double.
    """
    return F.round(total.cast("double") / count * 100) / 100


def crossed() -> Column:
    """Did the data leave its home region? Not the verdict: a flagged or allowed
    region counts as well, as long as it is not home."""
    return F.col("processing_region") != F.col("home_region")


def month(col: str = "txn_timestamp") -> Column:
    return F.trunc(F.col(col), "MM")


def daily_revenue_by_province(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per day and province."""
    per_customer = transactions.groupBy(
        F.col("txn_timestamp").cast("date").alias("txn_date"), "customer_id"
    ).agg(F.count("*").alias("n"), F.sum("amount_zar").alias("amount"))
    return (
        per_customer.join(customers.select("customer_id", "province"), "customer_id")
        .groupBy("txn_date", "province")
        .agg(
            F.sum("n").alias("transaction_count"),
            F.count("*").alias("unique_customers"),
            F.sum("amount").cast(TOTAL).alias("revenue_zar"),
            average(F.sum("amount"), F.sum("n")).alias("avg_transaction_zar"),
        )
    )


def customer_activity(transactions: DataFrame) -> DataFrame:
    """Totals and favourite merchant per customer, from one pass.

    Most visits win, ties go to the alphabetically first merchant. The winner is
    the least of (-visits, merchant): an aggregate, so that no task ever holds
    all merchants of a customer the way a window would.
    """
    visits = transactions.groupBy("customer_id", "merchant").agg(
        F.count("*").alias("n"),
        F.sum("amount_zar").alias("amount"),
        F.min("txn_timestamp").alias("first_at"),
        F.max("txn_timestamp").alias("last_at"),
        F.count_if(crossed()).alias("crossings"),
    )
    return visits.groupBy("customer_id").agg(
        F.sum("n").alias("transaction_count"),
        F.sum("amount").cast(TOTAL).alias("total_spend_zar"),
        average(F.sum("amount"), F.sum("n")).alias("avg_transaction_zar"),
        F.min("first_at").alias("first_txn_at"),
        F.max("last_at").alias("last_txn_at"),
        F.min(F.struct((-F.col("n")).alias("visits"), "merchant"))["merchant"].alias("favourite_merchant"),
        F.sum("crossings").alias("cross_border_txn_count"),
    )


def favourite_merchant(transactions: DataFrame) -> DataFrame:
    return customer_activity(transactions).select("customer_id", "favourite_merchant")


def customer_totals(transactions: DataFrame) -> DataFrame:
    """Totals per customer without the merchants, so without their grouping."""
    return transactions.groupBy("customer_id").agg(
        F.count("*").alias("transaction_count"),
        F.sum("amount_zar").cast(TOTAL).alias("total_spend_zar"),
        average(F.sum("amount_zar"), F.count("*")).alias("avg_transaction_zar"),
        F.min("txn_timestamp").alias("first_txn_at"),
        F.max("txn_timestamp").alias("last_txn_at"),
        F.count_if(crossed()).alias("cross_border_txn_count"),
    )


def customer_transaction_summary(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per silver customer, those without transactions included."""
    activity = customer_activity(transactions)
    zero = F.lit(0)
    return (
        customers.select("customer_id", "province", "signup_date")
        .join(activity, "customer_id", "left")
        .select(
            "customer_id",
            "province",
            "signup_date",
            F.coalesce("transaction_count", zero).alias("transaction_count"),
            F.coalesce("total_spend_zar", zero.cast(TOTAL)).alias("total_spend_zar"),
            "avg_transaction_zar",
            "first_txn_at",
            "last_txn_at",
            "favourite_merchant",
            F.coalesce("cross_border_txn_count", zero).alias("cross_border_txn_count"),
        )
    )


def monthly_volume(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(month().alias("transfer_month")).agg(F.count("*").alias("all_txns"))


def pii_categories(inventory: DataFrame, dataset: str = "customers") -> DataFrame:
    """The personal columns of a dataset as one sorted text; NULL if there are none."""
    return inventory.filter(F.col("dataset") == dataset).agg(
        F.expr("listagg(column_name, ', ') within group (order by column_name)").alias("pii_categories")
    )


def cross_border_transfer_report(transactions: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row per month and route out of the home region.

    One scan: domestic rows only feed the month's volume, so they collapse to one
    group per month and region before the shuffle; the volume is then a window
    over the few rows per month that remain.
    """
    per_subject = transactions.groupBy(
        month().alias("transfer_month"),
        "home_region",
        "processing_region",
        "residency_status",
        F.when(crossed(), F.col("customer_id")).alias("subject"),
    ).agg(
        F.count("*").alias("n"),
        F.sum("amount_zar").alias("amount"),
        F.min("txn_timestamp").alias("first_at"),
        F.max("txn_timestamp").alias("last_at"),
    )
    routes = per_subject.groupBy(
        "transfer_month", "home_region", "processing_region", "residency_status"
    ).agg(
        F.sum("n").alias("transfer_count"),
        F.count("subject").alias("data_subjects_affected"),
        F.sum("amount").cast(TOTAL).alias("amount_zar"),
        F.min("first_at").alias("first_transfer_at"),
        F.max("last_at").alias("last_transfer_at"),
    )
    volume = F.sum("transfer_count").over(Window.partitionBy("transfer_month"))
    return (
        routes.withColumn("volume", volume)
        .filter(crossed())
        .select(
            "transfer_month",
            "home_region",
            "processing_region",
            "residency_status",
            "transfer_count",
            "data_subjects_affected",
            "amount_zar",
            F.round(F.lit(100.0) * F.col("transfer_count") / F.col("volume"), 2).alias("pct_of_month_txns"),
            "first_transfer_at",
            "last_transfer_at",
            pii_categories(inventory).scalar().alias("pii_categories"),
        )
    )


def build_gold(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The three marts; they do not depend on each other."""
    transactions, customers = silver["transactions"], silver["customers"]
    return {
        "daily_revenue_by_province": daily_revenue_by_province(transactions, customers),
        "customer_transaction_summary": customer_transaction_summary(transactions, customers),
        "cross_border_transfer_report": cross_border_transfer_report(transactions, silver["pii_inventory"]),
    }
