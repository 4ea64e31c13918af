"""Raw deliveries derived from the shared test tables.

Customers come from ``customer``, transactions from ``orders``, row by row and
by arithmetic on the key, with faults strewn in; ``oracle`` states the same in
SQL. All columns are text, as a delivery has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from borderlake.operators.set_checks import union
from borderlake.sources.synthetic import (
    BROKEN_AMOUNT,
    BROKEN_PROVINCE,
    MERCHANTS,
    PROVINCES,
    UNKNOWN_CUSTOMER,
    iso_text,
    luhn_digit,
    numbered,
    padded,
)

# A key for checks only. It guards nothing.
CHECK_KEY = "borderlake-check-key"

CUSTOMERS = 97  # faults repeat every so many customers ...
TRANSACTIONS = 101  # ... and transactions


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _with_copies(rows: DataFrame) -> DataFrame:
    """Deliver every 103rd row twice."""
    times = F.when(F.col("k") % 103 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_copy", F.explode(times)).drop("_copy")


def _fault(cases: dict[int, str], modulus: int, sound: Column) -> Column:
    value = sound
    for remainder, broken in cases.items():
        value = F.when(F.col("k") % modulus == remainder, F.lit(broken)).otherwise(value)
    return value


def _choose(options: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))


def customer_id(k: Column) -> Column:
    return numbered("C", k, 7)


def transaction_id(k: Column) -> Column:
    return numbered("T", k, 9)


def customer_key() -> Column:
    """Every 113th customer, from the ninth, takes the id of the one before."""
    k = F.col("k")
    return customer_id(F.when(k % 113 == 9, k - 1).otherwise(k))


def transaction_key() -> Column:
    k = F.col("k")
    return transaction_id(F.when(k % TRANSACTIONS == 5, k - 1).otherwise(k))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, nation, payload, check = F.col("k"), F.col("nation"), F.col("payload"), F.col("check")
    month = F.when(k % CUSTOMERS == 7, F.lit("13")).otherwise(padded(k % 12 + 1, 2))
    rows = (
        _with_copies(
            source(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nation"))
        )
        .withColumn(
            "payload",
            F.concat(padded((k * 7) % 100, 2), month, padded(k % 28 + 1, 2), padded((k * 37) % 10_000, 4), F.lit("08")),
        )
        .withColumn("check", luhn_digit(payload))
    )
    wrong = ((check.cast("int") + 5) % 10).cast("string")
    email = F.concat(F.lit("USER"), k.cast("string"), F.lit("@Example.co.za"))
    email = F.when(k % 13 == 6, F.concat(F.lit("  "), email, F.lit("\t"))).otherwise(email)
    phone = F.concat(F.lit("+27"), padded((k * 7919) % 1_000_000_000, 9))
    family = F.concat(F.when(k % CUSTOMERS == 9, F.lit("van der L")).otherwise(F.lit("L")), (k % 500).cast("string"))
    province = _fault({3: BROKEN_PROVINCE}, CUSTOMERS, _choose(PROVINCES, nation % 9))
    # Personal values in a column that is not personal.
    province = F.when(k % CUSTOMERS == 8, F.btrim(email, F.lit(" \t"))).when(k % CUSTOMERS == 9, family).otherwise(province)
    signup = F.date_add(F.lit("2023-01-01").cast("date"), (k % 1000).cast("int")).cast("string")
    return rows.select(
        customer_key().alias("customer_id"),
        _fault({4: ""}, CUSTOMERS, F.concat(F.lit("F"), k.cast("string"))).alias("first_name"),
        family.alias("last_name"),
        F.concat(payload, F.when(k % CUSTOMERS == 1, wrong).otherwise(check)).alias("sa_id_number"),
        _fault({2: "user.example.com"}, CUSTOMERS, email).alias("email"),
        _fault({5: "0821234567"}, CUSTOMERS, F.when(k % 11 == 0, F.lit("")).otherwise(phone)).alias("phone"),
        F.concat(province, F.when(k % 83 == 0, F.lit("  ")).otherwise(F.lit(""))).alias("province"),
        _fault({6: "2023-02-30"}, CUSTOMERS, signup).alias("signup_date"),
        F.when(nation % 10 == 7, F.lit("eu-west-1")).otherwise(F.lit("af-south-1")).alias("home_region"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of every 50th customer go to the one before, who leaves none behind."""
    k, owner = F.col("k"), F.col("owner")
    person = F.when(owner % 50 == 49, owner - 1).otherwise(owner)
    owner_id = customer_id(person)
    email = F.concat(F.lit("USER"), person.cast("string"), F.lit("@Example.co.za"))
    phone = F.concat(F.lit("+27"), padded((person * 7919) % 1_000_000_000, 9))
    owner_id = F.when(k % 89 == 0, F.concat(F.lit(" "), owner_id, F.lit("\t "))).otherwise(owner_id)
    region = F.when(k % 25 == 0, F.lit("eu-west-1")).when(k % 25 == 1, F.lit("us-east-1")).otherwise(F.lit("af-south-1"))
    moment = F.col("placed") + F.make_dt_interval(secs=k % 86_400)
    rows = source(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("owner"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderdate").alias("placed"),
    )
    return _with_copies(rows).select(
        transaction_key().alias("transaction_id"),
        F.when(k % TRANSACTIONS == 11, email)
        .otherwise(_fault({3: UNKNOWN_CUSTOMER}, TRANSACTIONS, owner_id))
        .alias("customer_id"),
        _fault(
            {0: BROKEN_AMOUNT, 6: "abc", 7: "nan", 8: "1.0d"},
            TRANSACTIONS,
            F.col("price").cast("decimal(12,2)").cast("string"),
        ).alias("amount_zar"),
        F.when(k % TRANSACTIONS == 10, phone)
        .otherwise(_fault({1: "USD"}, TRANSACTIONS, F.lit("ZAR")))
        .alias("currency"),
        _fault({2: ""}, TRANSACTIONS, _choose(MERCHANTS, k % 10)).alias("merchant"),
        _fault({9: "not-a-time"}, TRANSACTIONS, iso_text(moment)).alias("txn_timestamp"),
        F.when(k % 251 == 7, F.lit("ap-south-1")).otherwise(region).alias("processing_region"),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"customers": customers(spark, sf_dir), "transactions": transactions(spark, sf_dir)}


def expected_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, record_key, rule) of every fault put in, cascades aside."""
    people = source(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    orders = source(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))

    def faults(rows: DataFrame, dataset: str, key: Column, modulus: int, rules: dict[int, list[str]], more: Column):
        found = F.array().cast("array<string>")
        for remainder, names in rules.items():
            found = F.when(F.col("k") % modulus == remainder, F.array(*[F.lit(n) for n in names])).otherwise(found)
        return rows.select(
            F.lit(dataset).alias("dataset"), key.alias("record_key"), F.explode(F.concat(found, more)).alias("rule")
        )

    def also(condition: Column, rule: str) -> Column:
        return F.when(condition, F.array(F.lit(rule))).otherwise(F.array().cast("array<string>"))

    return union(
        [
            faults(
                people,
                "customers",
                customer_key(),
                CUSTOMERS,
                {
                    1: ["sa_id"],
                    2: ["email"],
                    3: ["allowed_values"],
                    4: ["not_null"],
                    5: ["phone"],
                    6: ["type"],
                    7: ["sa_id"],
                    8: ["allowed_values"],
                    9: ["allowed_values"],
                },
                also(F.col("k") % 113 == 9, "unique"),
            ),
            faults(
                orders,
                "transactions",
                transaction_key(),
                TRANSACTIONS,
                {
                    0: ["min"],
                    1: ["allowed_values"],
                    2: ["not_null"],
                    3: ["referential_integrity"],
                    5: ["unique"],
                    6: ["type", "min"],
                    7: ["min"],
                    8: ["type", "min"],
                    9: ["type"],
                    10: ["allowed_values"],
                    11: ["referential_integrity"],
                },
                also(F.col("k") % 251 == 7, "residency_blocked"),
            ),
        ]
    ).distinct()
