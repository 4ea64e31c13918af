"""Invariants of a build, each as a small DataFrame of findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from borderlake.functions.text import cell
from borderlake.operators.contracts import pii_columns
from borderlake.operators.gold import crossed
from borderlake.operators.leaks import hidden_key, leaking_texts, said_values, with_leaks
from borderlake.operators.set_checks import union
from borderlake.operators.skew import sliced_join


def record_balance(
    bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, contract: dict
) -> DataFrame:
    """Is every raw key in silver or in quarantine, and never in both? Keys are compared as
    digests, as quarantine has those that name a person in that form only."""
    dataset, key = contract["dataset"], contract["primary_key"]

    def seen(keys: DataFrame, place: str) -> DataFrame:
        flags = [F.lit(p == place).alias(p) for p in ("raw", "kept", "rejected")]
        return keys.select(hidden_key(F.col("key")).alias("key"), *flags)

    rejected = quarantine.filter(F.col("dataset") == dataset)
    keys = union(
        [
            seen(bronze.select(cell(key).alias("key")), "raw"),
            seen(silver.select(F.col(key).alias("key")), "kept"),
            seen(rejected.select(F.col("record_key").alias("key")), "rejected"),
        ]
    )
    state = keys.groupBy("key").agg(*[F.bool_or(p).alias(p) for p in ("raw", "kept", "rejected")])
    raw, kept, gone = F.col("raw"), F.col("kept"), F.col("rejected")
    return state.agg(
        F.count_if(raw).alias("raw_keys"),
        F.count_if(raw & kept & ~gone).alias("silver_only"),
        F.count_if(raw & gone & ~kept).alias("quarantine_only"),
        F.count_if(kept & gone).alias("in_both"),
        F.count_if(raw & ~kept & ~gone).alias("lost"),
        F.count_if(~raw).alias("invented"),
    ).select(F.lit(dataset).alias("dataset"), "*")


def key_duplicates(table: DataFrame, key: str, name: str) -> DataFrame:
    return table.agg(
        F.count("*").alias("row_count"), (F.count("*") - F.count_distinct(key)).alias("duplicates")
    ).select(F.lit(name).alias("table_name"), "*")


def dangling_transactions(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Silver transactions without a silver customer, counted per customer first."""
    owners = transactions.groupBy("customer_id").agg(F.count("*").alias("n"))
    return owners.join(customers.select("customer_id"), "customer_id", "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("dangling")
    )


def typed_columns(table: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """Type of each column and how many values are missing; a fit value that a
    tolerant cast lost would show up here."""
    totals = table.agg(
        F.count("*").alias("row_count"),
        *[F.count(c).alias(f"_{c}") for c in columns],
        *[F.any_value(F.typeof(c)).alias(f"_type_{c}") for c in columns],
    )
    described = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"_type_{c}").alias("type_name"),
                (F.col("row_count") - F.col(f"_{c}")).alias("missing"),
            )
            for c in columns
        ]
    )
    return totals.select(F.lit(name).alias("table_name"), "row_count", F.inline(described))


def pii_leaks(silver: DataFrame, bronze: DataFrame, contract: dict) -> DataFrame:
    """For each personal column: is it in silver, and does a raw value survive there?"""
    key = contract["primary_key"]
    masks = {s["name"]: s.get("mask", "none") for s in contract["columns"]}
    personal = pii_columns(contract)
    present = [c for c in personal if c in silver.columns]
    raw = bronze.select(cell(key).alias(key), *[cell(c).alias(f"_raw_{c}") for c in present])
    counts = (
        sliced_join(raw.distinct(), silver.select(key, *present), key, "inner")
        .agg(*[F.count_if(F.col(c) == F.col(f"_raw_{c}")).alias(f"_{c}") for c in present])
    )

    def finding(c: str) -> Column:
        return F.struct(
            F.lit(c).alias("column_name"),
            F.lit(masks[c]).alias("mask_strategy"),
            F.lit(c in present).alias("in_silver"),
            (F.col(f"_{c}") if c in present else F.lit(0).cast("bigint")).alias("leaks"),
        )

    return counts.select(F.inline(F.array(*[finding(c) for c in personal])))


def reason_leaks(
    quarantine: DataFrame, contracts: dict[str, dict], values: DataFrame, fixed: DataFrame
) -> DataFrame:
    """Per column with rejections: how many reasons there are, and how many let a personal value out.

    Those of personal columns must only say that a rule failed. All others, and the record
    keys, are searched for every raw value of every personal column (``values``; ``fixed``
    is the wording of the rules)."""
    personal = F.lit(False)
    for name, contract in contracts.items():
        personal = personal | ((F.col("dataset") == name) & F.col("column_name").isin(pii_columns(contract)))
    plain = F.concat("rule", F.lit(" check failed (value redacted: PII)"))
    marked = with_leaks(quarantine, leaking_texts(quarantine, values, fixed))
    wrong = (personal & (F.col("reason") != plain)) | F.col("_reason_leaks")
    return marked.groupBy("dataset", "column_name").agg(
        F.count("*").alias("reasons"), F.count_if(wrong).alias("leaks"), F.count_if("_key_leaks").alias("key_leaks")
    )


def spilled_values(reasons: DataFrame, values: DataFrame, fixed: DataFrame) -> DataFrame:
    """Which personal column's values stand in which column's reasons: the number of reasons,
    per rule. Meant for reasons before redaction, to see where people type what."""
    said = said_values(reasons.select(F.col("reason").alias("text")).filter("text is not null").distinct(), values, fixed)
    kinds = values.select("value", F.col("dataset").alias("value_dataset"), F.col("column_name").alias("value_column"))
    named = said.join(kinds, "value").select(F.col("text").alias("reason"), "value_dataset", "value_column").distinct()
    return (
        reasons.select("dataset", "column_name", "rule", "reason")
        .join(named, "reason")
        .groupBy("dataset", "column_name", "rule", "value_dataset", "value_column")
        .agg(F.count("*").alias("reasons"))
    )


def inventory_in_use(bronze: dict[str, DataFrame], inventory: DataFrame, contracts: dict[str, dict]) -> DataFrame:
    """The personal columns with the number of raw values each holds."""
    held = []
    for name, table in bronze.items():
        personal = pii_columns(contracts[name])
        if personal:
            counts = table.agg(*[F.count_if(cell(c) != "").alias(c) for c in personal])
            entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("values_held")) for c in personal]
            held.append(counts.select(F.lit(name).alias("dataset"), F.inline(F.array(*entries))))
    return inventory.join(union(held), ["dataset", "column_name"], "left")


def reconcile_daily(daily: DataFrame, transactions: DataFrame) -> DataFrame:
    return _reconcile(
        daily.agg(F.sum("transaction_count").alias("mart_count"), F.sum("revenue_zar").alias("mart_amount")),
        transactions.agg(F.count("*").alias("silver_count"), F.sum("amount_zar").alias("silver_amount")),
    )


def reconcile_customers(summary: DataFrame, transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """One summary row per customer, and the spend adds up."""
    return _reconcile(
        summary.agg(
            F.count("*").alias("mart_count"),
            F.count_distinct("customer_id").alias("mart_keys"),
            F.sum("total_spend_zar").alias("mart_amount"),
        ),
        customers.agg(F.count("*").alias("silver_count")),
        transactions.agg(F.sum("amount_zar").alias("silver_amount")),
    )


def reconcile_transfers(report: DataFrame, transactions: DataFrame) -> DataFrame:
    """The report has every crossing, nothing domestic, and names the id number."""
    return _reconcile(
        report.agg(
            F.sum("transfer_count").alias("mart_count"),
            F.sum("amount_zar").alias("mart_amount"),
            F.count_if(~crossed()).alias("domestic_rows"),
            F.count_if(~F.col("pii_categories").like("%sa_id_number%")).alias("unnamed_rows"),
        ),
        transactions.filter(crossed()).agg(
            F.count("*").alias("silver_count"), F.sum("amount_zar").alias("silver_amount")
        ),
    )


def _reconcile(mart: DataFrame, *silver: DataFrame) -> DataFrame:
    """Put one-row totals side by side and say whether they agree."""
    for totals in silver:
        mart = mart.select("*", *[totals.select(c).scalar().alias(c) for c in totals.columns])
    money = [F.col(c).cast("decimal(38,2)") for c in ("mart_amount", "silver_amount")]
    same = (F.col("mart_count") == F.col("silver_count")) & money[0].eqNullSafe(money[1])
    return mart.withColumn("reconciles", same)


def fingerprint(table: DataFrame, name: str, volatile: tuple[str, ...] = ("_ingested_at",)) -> DataFrame:
    """Row count and an order-free digest of a table's contents, lineage time aside."""
    columns = sorted(c for c in table.columns if c not in volatile)
    return table.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("digest"),
    ).select(F.lit(name).alias("table_name"), "*")


def changed_rows(before: DataFrame, after: DataFrame, volatile: tuple[str, ...] = ("_ingested_at",)) -> DataFrame:
    """Rows that only one of two versions of a table has, copies counted."""
    columns = [c for c in before.columns if c not in volatile]
    old, new = before.select(*columns), after.select(*columns)
    return old.exceptAll(new).withColumn("side", F.lit("before")).unionByName(
        new.exceptAll(old).withColumn("side", F.lit("after"))
    )


def unexpected_rejections(quarantine: DataFrame, expected: DataFrame) -> DataFrame:
    """Rejections beyond an expected set of (dataset, record_key, rule)."""
    found = quarantine.select("dataset", "record_key", "rule").distinct()
    return found.join(expected.distinct(), ["dataset", "record_key", "rule"], "left_anti")
