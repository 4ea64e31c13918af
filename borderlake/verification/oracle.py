"""The registered queries as DuckDB SQL, written from the definitions.

One chain of common table expressions derives the raw deliveries, judges them
and builds silver and gold the plain way (anti-joins against the whole
quarantine, windows, distinct counts); each query selects from it.
"""

from __future__ import annotations

import hashlib
import json

from borderlake.sources.synthetic import (
    BROKEN_AMOUNT,
    BROKEN_PROVINCE,
    CUSTOMER_FIELDS,
    FIRST_NAMES,
    FOREIGN_REGIONS,
    LAST_NAMES,
    MAX_CENTS,
    MERCHANTS,
    MIN_CENTS,
    PHONE_PREFIXES,
    PROVINCES,
    SEED,
    TRANSACTION_FIELDS,
    UNKNOWN_CUSTOMER,
)
from borderlake.verification.derived import CHECK_KEY


def _list(options: list[str]) -> str:
    return "[" + ", ".join(f"'{o}'" for o in options) + "]"


def _luhn_sum(text: str, length: int) -> str:
    terms = []
    for i in range(1, length + 1):
        d = f"CAST(substr({text}, {i}, 1) AS INT)"
        terms.append(d if i % 2 else f"({d} * 2 - CASE WHEN {d} > 4 THEN 9 ELSE 0 END)")
    return "(" + " + ".join(terms) + ")"


def _pads() -> tuple[str, str]:
    raw = CHECK_KEY.encode()
    raw = (hashlib.sha256(raw).digest() if len(raw) > 64 else raw).ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in raw).hex(), bytes(b ^ 0x5C for b in raw).hex()


def _t(col: str) -> str:
    return f"trim({col}, ' ' || chr(9))"


def _verdict(home: str, region: str) -> str:
    return (
        f"CASE WHEN {home} IS NULL OR {region} IS NULL THEN NULL WHEN {region} = {home} THEN 'domestic' "
        f"WHEN {region} = 'af-south-1' THEN 'domestic' "
        f"WHEN {region} IN ('eu-west-1', 'us-east-1') THEN 'cross_border_flagged' ELSE 'blocked' END"
    )


NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"

BRONZE = f"""
raw_customers AS (
    SELECT c_custkey AS k, c_nationkey AS nation,
           lpad(CAST((c_custkey * 7) % 100 AS VARCHAR), 2, '0')
           || CASE WHEN c_custkey % 97 = 7 THEN '13' ELSE lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') END
           || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0')
           || lpad(CAST((c_custkey * 37) % 10000 AS VARCHAR), 4, '0') || '08' AS payload
    FROM customer, (SELECT unnest([0, 1]) AS copy) WHERE copy = 0 OR c_custkey % 103 = 0
),
checked_customers AS (
    SELECT *, (10 - {_luhn_sum('payload', 12)} % 10) % 10 AS digit FROM raw_customers
),
bronze_customers AS (
    SELECT printf('C%07d', CASE WHEN k % 113 = 9 THEN k - 1 ELSE k END) AS customer_id,
           CASE WHEN k % 97 = 4 THEN '' ELSE 'F' || k END AS first_name,
           CASE WHEN k % 97 = 9 THEN 'van der L' ELSE 'L' END || (k % 500) AS last_name,
           payload || CASE WHEN k % 97 = 1 THEN (digit + 5) % 10 ELSE digit END AS sa_id_number,
           CASE WHEN k % 97 = 2 THEN 'user.example.com'
                WHEN k % 13 = 6 THEN '  USER' || k || '@Example.co.za' || chr(9)
                ELSE 'USER' || k || '@Example.co.za' END AS email,
           CASE WHEN k % 97 = 5 THEN '0821234567' WHEN k % 11 = 0 THEN ''
                ELSE '+27' || lpad(CAST((k * 7919) % 1000000000 AS VARCHAR), 9, '0') END AS phone,
           CASE WHEN k % 97 = 3 THEN '{BROKEN_PROVINCE}' WHEN k % 97 = 8 THEN 'USER' || k || '@Example.co.za'
                WHEN k % 97 = 9 THEN 'van der L' || (k % 500) ELSE ({_list(PROVINCES)})[nation % 9 + 1] END
           || CASE WHEN k % 83 = 0 THEN '  ' ELSE '' END AS province,
           CASE WHEN k % 97 = 6 THEN '2023-02-30'
                ELSE CAST(DATE '2023-01-01' + CAST(k % 1000 AS INT) AS VARCHAR) END AS signup_date,
           CASE WHEN nation % 10 = 7 THEN 'eu-west-1' ELSE 'af-south-1' END AS home_region
    FROM checked_customers
),
raw_transactions AS (
    SELECT o_orderkey AS k, CASE WHEN o_custkey % 50 = 49 THEN o_custkey - 1 ELSE o_custkey END AS owner,
           o_totalprice AS price, o_orderdate AS placed
    FROM orders, (SELECT unnest([0, 1]) AS copy) WHERE copy = 0 OR o_orderkey % 103 = 0
),
bronze_transactions AS (
    SELECT printf('T%09d', CASE WHEN k % 101 = 5 THEN k - 1 ELSE k END) AS transaction_id,
           CASE WHEN k % 101 = 3 THEN '{UNKNOWN_CUSTOMER}' WHEN k % 101 = 11 THEN 'USER' || owner || '@Example.co.za'
                WHEN k % 89 = 0 THEN printf(' C%07d', owner) || chr(9) || ' '
                ELSE printf('C%07d', owner) END AS customer_id,
           CASE k % 101 WHEN 0 THEN '{BROKEN_AMOUNT}' WHEN 6 THEN 'abc' WHEN 7 THEN 'nan' WHEN 8 THEN '1.0d'
                ELSE CAST(CAST(price AS DECIMAL(12,2)) AS VARCHAR) END AS amount_zar,
           CASE k % 101 WHEN 1 THEN 'USD' WHEN 10 THEN '+27' || lpad(CAST((owner * 7919) % 1000000000 AS VARCHAR), 9, '0')
                ELSE 'ZAR' END AS currency,
           CASE WHEN k % 101 = 2 THEN '' ELSE ({_list(MERCHANTS)})[k % 10 + 1] END AS merchant,
           CASE WHEN k % 101 = 9 THEN 'not-a-time'
                ELSE strftime(placed + to_seconds(k % 86400), '%Y-%m-%dT%H:%M:%S') END AS txn_timestamp,
           CASE WHEN k % 251 = 7 THEN 'ap-south-1' WHEN k % 25 = 0 THEN 'eu-west-1'
                WHEN k % 25 = 1 THEN 'us-east-1' ELSE 'af-south-1' END AS processing_region
    FROM raw_transactions
)"""

ROWS = f"""
unique_customers AS (
    SELECT DISTINCT * REPLACE ({_t('customer_id')} AS customer_id) FROM bronze_customers
),
unique_transactions AS (
    SELECT DISTINCT * REPLACE ({_t('transaction_id')} AS transaction_id, {_t('customer_id')} AS customer_id)
    FROM bronze_transactions
),
clean_customers AS (
    SELECT customer_id, {_t('first_name')} AS first_name, {_t('last_name')} AS last_name,
           {_t('sa_id_number')} AS sa_id_number, {_t('email')} AS email, {_t('phone')} AS phone,
           {_t('province')} AS province, {_t('signup_date')} AS signup_date, {_t('home_region')} AS home_region
    FROM unique_customers
),
clean_transactions AS (
    SELECT transaction_id, customer_id, {_t('amount_zar')} AS amount_zar, {_t('currency')} AS currency,
           {_t('merchant')} AS merchant, {_t('txn_timestamp')} AS txn_timestamp,
           {_t('processing_region')} AS processing_region
    FROM unique_transactions
)"""


def _not_null(dataset: str, key: str, table: str, columns: list[str]) -> list[str]:
    return [
        f"SELECT '{dataset}' AS dataset, {key} AS record_key, '{c}' AS column_name, 'not_null' AS rule, "
        f"'Required field is missing or empty' AS reason FROM {table} WHERE {c} = ''"
        for c in columns
    ]


def _broken(dataset: str, key: str, table: str, column: str, rule: str, passes: str, reason: str) -> str:
    return (
        f"SELECT '{dataset}', {key}, '{column}', '{rule}', {reason} FROM {table} "
        f"WHERE {column} <> '' AND NOT coalesce({passes}, false)"
    )


_C = ("customers", "customer_id", "clean_customers")
_T = ("transactions", "transaction_id", "clean_transactions")
_AMOUNT = f"regexp_full_match(amount_zar, '{NUMBER}')"

ROW_RULES = " UNION ALL ".join(
    [
        *_not_null(
            *_C,
            ["customer_id", "first_name", "last_name", "sa_id_number", "email", "province", "signup_date", "home_region"],
        ),
        _broken(
            *_C,
            "sa_id_number",
            "sa_id",
            "regexp_full_match(sa_id_number, '[0-9]{13}') "
            "AND try_strptime(substr(sa_id_number, 1, 6), '%y%m%d') IS NOT NULL "
            f"AND {_luhn_sum('sa_id_number', 13)} % 10 = 0",
            "'Invalid SA ID (format or checksum): ''' || sa_id_number || ''''",
        ),
        _broken(
            *_C,
            "email",
            "email",
            r"regexp_full_match(email, '[^@\s]+@[^@\s]+\.[^@\s]+')",
            "'Invalid email: ''' || email || ''''",
        ),
        _broken(
            *_C,
            "phone",
            "phone",
            r"regexp_full_match(phone, '\+27[0-9]{9}')",
            "'Phone must be +27 then 9 digits: ''' || phone || ''''",
        ),
        _broken(
            *_C,
            "province",
            "allowed_values",
            f"list_contains({_list(PROVINCES)}, province)",
            "'''' || province || ''' not in allowed set " + str(PROVINCES).replace("'", "''") + "'",
        ),
        _broken(
            *_C,
            "signup_date",
            "type",
            "regexp_full_match(signup_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(signup_date AS DATE) IS NOT NULL",
            "'Cannot read ''' || signup_date || ''' as date'",
        ),
        *_not_null(
            *_T,
            ["transaction_id", "customer_id", "amount_zar", "currency", "merchant", "txn_timestamp", "processing_region"],
        ),
        _broken(
            *_T,
            "amount_zar",
            "type",
            f"{_AMOUNT} OR lower(amount_zar) = 'nan'",
            "'Cannot read ''' || amount_zar || ''' as decimal'",
        ),
        _broken(
            *_T,
            "amount_zar",
            "min",
            f"{_AMOUNT} AND TRY_CAST(amount_zar AS DOUBLE) >= 0",
            f"CASE WHEN {_AMOUNT} OR lower(amount_zar) = 'nan' "
            "THEN CAST(TRY_CAST(amount_zar AS DOUBLE) AS VARCHAR) || ' is below minimum 0' "
            "ELSE 'Not a number: ''' || amount_zar || '''' END",
        ),
        _broken(
            *_T, "currency", "allowed_values", "currency = 'ZAR'", "'''' || currency || ''' not in allowed set [''ZAR'']'"
        ),
        _broken(
            *_T,
            "txn_timestamp",
            "type",
            "TRY_CAST(txn_timestamp AS TIMESTAMP) IS NOT NULL",
            "'Cannot read ''' || txn_timestamp || ''' as timestamp'",
        ),
    ]
)


def _words(text: str) -> str:
    pieces = rf"string_split_regex(lower({text}), '[\x00-\x20''\"()\[\]{{}}<>,;:=|]+')"
    return (
        f"list_filter(list_transform({pieces}, lambda w: regexp_replace(w, '^[.!?]+|[.!?]+$', '', 'g')), lambda w: w <> '')"
    )


VIOLATIONS = f"""
row_violations AS (SELECT DISTINCT * FROM ({ROW_RULES})),
dup_customers AS (
    SELECT customer_id, count(*) AS n FROM unique_customers GROUP BY 1 HAVING count(*) > 1
),
dup_transactions AS (
    SELECT transaction_id, count(*) AS n FROM unique_transactions GROUP BY 1 HAVING count(*) > 1
),
set_violations AS (
    SELECT 'customers' AS dataset, customer_id AS record_key, 'customer_id' AS column_name, 'unique' AS rule,
           'customer_id appears ' || n || ' times' AS reason FROM dup_customers
    UNION SELECT 'transactions', transaction_id, 'transaction_id', 'unique',
           'transaction_id appears ' || n || ' times' FROM dup_transactions
    UNION SELECT 'transactions', t.transaction_id, 'customer_id', 'referential_integrity',
           'customer_id ''' || t.customer_id || ''' not found in customers'
    FROM unique_transactions t LEFT JOIN unique_customers c ON c.customer_id = t.customer_id
    WHERE c.customer_id IS NULL
),
redacted_rows AS (
    SELECT DISTINCT dataset, record_key, column_name, rule,
           CASE WHEN dataset = 'customers'
                     AND column_name IN ('first_name', 'last_name', 'sa_id_number', 'email', 'phone')
                THEN rule || ' check failed (value redacted: PII)' ELSE reason END AS reason
    FROM row_violations
),
violations AS (SELECT * FROM redacted_rows UNION SELECT * FROM set_violations),
parent_reasons AS (
    SELECT DISTINCT 'transactions' AS dataset, transaction_id AS record_key, 'customer_id' AS column_name,
           'parent_quarantined' AS rule, 'customer ' || customer_id || ' is quarantined' AS reason
    FROM unique_transactions
    SEMI JOIN (SELECT record_key AS customer_id FROM violations WHERE dataset = 'customers') USING (customer_id)
),
placed AS (
    SELECT transaction_id, processing_region, {_verdict('home_region', 'processing_region')} AS verdict
    FROM clean_transactions JOIN clean_customers USING (customer_id)
),
blocked_reasons AS (
    SELECT DISTINCT 'transactions' AS dataset, transaction_id AS record_key, 'processing_region' AS column_name,
           'residency_blocked' AS rule, concat('processing_region ', processing_region, ' -> ', verdict) AS reason
    FROM placed WHERE verdict = 'blocked'
),
reasons AS (SELECT * FROM violations UNION SELECT * FROM parent_reasons UNION SELECT * FROM blocked_reasons),
personal AS (
    SELECT DISTINCT column_name, array_to_string({_words('text')}, ' ') AS value
    FROM (UNPIVOT (SELECT first_name, last_name, sa_id_number, email, phone FROM clean_customers)
          ON COLUMNS(*) INTO NAME column_name VALUE text)
    WHERE len({_words('text')}) > 0
),
spilled AS (
    SELECT DISTINCT text, column_name
    FROM (SELECT reason AS text FROM reasons UNION SELECT record_key FROM reasons), personal
    WHERE contains(' ' || array_to_string({_words('text')}, ' ') || ' ', ' ' || value || ' ')
),
quarantine AS (
    SELECT DISTINCT dataset,
           CASE WHEN record_key IN (SELECT text FROM spilled) THEN 'row_' || substr(sha256(record_key), 1, 32)
                ELSE record_key END AS record_key,
           column_name, rule,
           CASE WHEN reason IN (SELECT text FROM spilled) THEN rule || ' check failed (value redacted: PII)'
                ELSE reason END AS reason,
           'bronze.' || dataset AS source_table
    FROM reasons
)"""

_IPAD, _OPAD = _pads()


def _token(col: str) -> str:
    return f"sha256(unhex('{_OPAD}') || unhex(sha256(unhex('{_IPAD}') || encode({col}))))"


SILVER = f"""
silver_customers AS (
    SELECT c.customer_id, {_token('c.sa_id_number')} AS sa_id_number, sha256(lower(c.email)) AS email,
           right(nullif(c.phone, ''), 3) AS phone, c.province, TRY_CAST(c.signup_date AS DATE) AS signup_date,
           c.home_region
    FROM clean_customers c
    WHERE c.customer_id NOT IN (SELECT record_key FROM reasons WHERE dataset = 'customers')
),
silver_transactions AS (
    SELECT t.transaction_id, t.customer_id, TRY_CAST(t.amount_zar AS DECIMAL(12,2)) AS amount_zar, t.currency,
           t.merchant, TRY_CAST(t.txn_timestamp AS TIMESTAMP) AS txn_timestamp, c.home_region, t.processing_region,
           {_verdict('c.home_region', 't.processing_region')} AS residency_status
    FROM clean_transactions t JOIN silver_customers c ON c.customer_id = t.customer_id
    WHERE t.transaction_id NOT IN (SELECT record_key FROM reasons WHERE dataset = 'transactions')
),
inventory AS (
    SELECT * FROM (VALUES ('customers', 'first_name', 'drop'), ('customers', 'last_name', 'drop'),
        ('customers', 'sa_id_number', 'tokenise'), ('customers', 'email', 'hash'), ('customers', 'phone', 'partial')
    ) AS v(dataset, column_name, mask_strategy)
),
held AS (
    SELECT 'first_name' AS column_name, count(*) AS values_held FROM bronze_customers WHERE {_t('first_name')} <> ''
    UNION ALL SELECT 'last_name', count(*) FROM bronze_customers WHERE {_t('last_name')} <> ''
    UNION ALL SELECT 'sa_id_number', count(*) FROM bronze_customers WHERE {_t('sa_id_number')} <> ''
    UNION ALL SELECT 'email', count(*) FROM bronze_customers WHERE {_t('email')} <> ''
    UNION ALL SELECT 'phone', count(*) FROM bronze_customers WHERE {_t('phone')} <> ''
)"""

GOLD = """
daily AS (
    SELECT CAST(t.txn_timestamp AS DATE) AS txn_date, c.province, count(*) AS transaction_count,
           count(DISTINCT t.customer_id) AS unique_customers, sum(t.amount_zar) AS revenue_zar,
           round(avg(t.amount_zar), 2) AS avg_transaction_zar
    FROM silver_transactions t JOIN silver_customers c ON c.customer_id = t.customer_id
    GROUP BY CAST(t.txn_timestamp AS DATE), c.province
),
visits AS (
    SELECT customer_id, merchant, count(*) AS n, sum(amount_zar) AS spent, min(txn_timestamp) AS opened,
           max(txn_timestamp) AS closed, sum(CAST(processing_region <> home_region AS INT)) AS abroad
    FROM silver_transactions GROUP BY customer_id, merchant
),
activity AS (
    SELECT customer_id, CAST(sum(n) AS BIGINT) AS transaction_count, sum(spent) AS total_spend_zar,
           round(CAST(sum(spent) AS DOUBLE) / sum(n), 2) AS avg_transaction_zar, min(opened) AS first_txn_at,
           max(closed) AS last_txn_at, CAST(sum(abroad) AS BIGINT) AS cross_border_txn_count,
           list(merchant ORDER BY n DESC, merchant)[1] AS favourite_merchant
    FROM visits GROUP BY customer_id
),
summary AS (
    SELECT customer_id, province, signup_date, ifnull(transaction_count, 0) AS transaction_count,
           ifnull(total_spend_zar, 0) AS total_spend_zar, avg_transaction_zar, first_txn_at, last_txn_at,
           favourite_merchant, ifnull(cross_border_txn_count, 0) AS cross_border_txn_count
    FROM activity RIGHT JOIN silver_customers USING (customer_id)
),
routes AS (
    SELECT CAST(date_trunc('month', txn_timestamp) AS DATE) AS transfer_month, home_region, processing_region,
           residency_status, count(*) AS transfer_count, count(DISTINCT customer_id) AS data_subjects_affected,
           sum(amount_zar) AS amount_zar, min(txn_timestamp) AS first_transfer_at, max(txn_timestamp) AS last_transfer_at
    FROM silver_transactions GROUP BY ALL
),
shares AS (
    SELECT *, round(100.0 * transfer_count / sum(transfer_count) OVER (PARTITION BY transfer_month), 2) AS pct_of_month_txns
    FROM routes
),
report AS (
    SELECT shares.*, names.pii_categories
    FROM shares, (SELECT string_agg(column_name, ', ' ORDER BY column_name) AS pii_categories FROM inventory) AS names
    WHERE processing_region <> home_region
),
crossings AS (
    SELECT customer_id, count(*) FILTER (WHERE processing_region = home_region) AS domestic_txns,
           count(*) FILTER (WHERE processing_region <> home_region) AS transfer_count,
           count(DISTINCT processing_region) FILTER (WHERE processing_region <> home_region) AS region_count
    FROM silver_transactions GROUP BY customer_id
    HAVING count(*) FILTER (WHERE processing_region <> home_region) > 0
),
stamps AS (
    SELECT transaction_id, customer_id, processing_region, residency_status, CAST(amount_zar AS DOUBLE) AS amount_zar,
           merchant, strftime(txn_timestamp, '%Y-%m-%d') AS txn_date, txn_timestamp
    FROM silver_transactions WHERE processing_region <> home_region
),
pages AS (
    SELECT customer_id, (place - 1) // 2 AS page,
           list({'transaction_id': transaction_id, 'processing_region': processing_region,
                 'residency_status': residency_status, 'amount_zar': amount_zar, 'merchant': merchant,
                 'txn_date': txn_date} ORDER BY place) AS stamps
    FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY txn_timestamp, transaction_id) AS place FROM stamps)
    GROUP BY ALL
),
people AS (
    SELECT c.* REPLACE (CAST(signup_date AS VARCHAR) AS signup_date), x.domestic_txns, x.region_count, x.transfer_count
    FROM silver_customers c JOIN crossings x USING (customer_id)
),
subjects AS (SELECT * FROM people JOIN pages USING (customer_id))"""

CHAIN = "WITH " + ",".join([BRONZE, ROWS, VIOLATIONS, SILVER, GOLD]) + "\n"

_DAILY = (
    "SELECT CAST(txn_date AS VARCHAR) AS txn_date, province, transaction_count, unique_customers, "
    "CAST(revenue_zar AS DOUBLE) AS revenue_zar, avg_transaction_zar FROM daily"
)
_SUMMARY = (
    "SELECT customer_id, province, CAST(signup_date AS VARCHAR) AS signup_date, transaction_count, "
    "CAST(total_spend_zar AS DOUBLE) AS total_spend_zar, avg_transaction_zar, "
    "CAST(first_txn_at AS VARCHAR) AS first_txn_at, CAST(last_txn_at AS VARCHAR) AS last_txn_at, "
    "favourite_merchant, cross_border_txn_count FROM summary"
)
_REPORT = (
    "SELECT CAST(transfer_month AS VARCHAR) AS transfer_month, home_region, processing_region, residency_status, "
    "transfer_count, data_subjects_affected, CAST(amount_zar AS DOUBLE) AS amount_zar, pct_of_month_txns, "
    "CAST(first_transfer_at AS VARCHAR) AS first_transfer_at, CAST(last_transfer_at AS VARCHAR) AS last_transfer_at, "
    "pii_categories FROM report"
)
_CUSTOMERS = "SELECT * REPLACE (CAST(signup_date AS VARCHAR) AS signup_date) FROM silver_customers"
_TRANSACTIONS = (
    "SELECT * REPLACE (CAST(amount_zar AS DOUBLE) AS amount_zar, CAST(txn_timestamp AS VARCHAR) AS txn_timestamp) "
    "FROM silver_transactions"
)
_SUBJECTS = "SELECT * REPLACE (CAST(to_json(stamps) AS VARCHAR) AS stamps) FROM subjects"

_TABLES = {
    "bronze": {
        "customers": "bronze_customers",
        "transactions": "bronze_transactions",
    },
    "gold": {
        "cross_border_transfer_report": "report",
        "customer_transaction_summary": "summary",
        "daily_revenue_by_province": "daily",
    },
    "silver": {
        "customers": "silver_customers",
        "pii_inventory": "inventory",
        "quarantine": "quarantine",
        "transactions": "silver_transactions",
    },
}

_LINEAGE_TYPES = ["_source_file:string", "_ingested_at:string"]
# Columns of the stored tables, money as published (double).
_COLUMNS = {
    "silver.customers": [
        "customer_id:string", "sa_id_number:string", "email:string", "phone:string", "province:string",
        "signup_date:date", "home_region:string", *_LINEAGE_TYPES,
    ],
    "silver.pii_inventory": ["dataset:string", "column_name:string", "mask_strategy:string"],
    "silver.quarantine": [
        "record_key:string", "column_name:string", "rule:string", "reason:string", "source_table:string",
        "dataset:string",
    ],
    "silver.transactions": [
        "transaction_id:string", "customer_id:string", "amount_zar:double", "currency:string", "merchant:string",
        "txn_timestamp:timestamp_ntz", "home_region:string", "processing_region:string", "residency_status:string",
        *_LINEAGE_TYPES,
    ],
    "gold.daily_revenue_by_province": [
        "txn_date:date", "province:string", "transaction_count:bigint", "unique_customers:bigint",
        "revenue_zar:double", "avg_transaction_zar:double",
    ],
    "gold.customer_transaction_summary": [
        "customer_id:string", "province:string", "signup_date:date", "transaction_count:bigint",
        "total_spend_zar:double", "avg_transaction_zar:double", "first_txn_at:timestamp_ntz",
        "last_txn_at:timestamp_ntz", "favourite_merchant:string", "cross_border_txn_count:bigint",
    ],
    "gold.cross_border_transfer_report": [
        "transfer_month:date", "home_region:string", "processing_region:string", "residency_status:string",
        "transfer_count:bigint", "data_subjects_affected:bigint", "amount_zar:double", "pct_of_month_txns:double",
        "first_transfer_at:timestamp_ntz", "last_transfer_at:timestamp_ntz", "pii_categories:string",
    ],
}

def _counts(*layers: str, label: str = "table_name", name: str = "{table}", extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name.format(layer=layer, table=table)}' AS {label}, count(*) AS row_count{extra} FROM {source}"
        for layer in layers
        for table, source in _TABLES[layer].items()
    )


def _contents(*layers: str, label: str = "table_name", name: str = "{table}") -> str:
    """Rows of stored tables and an order-free sum over their contents."""

    def select(layer: str, table: str, source: str) -> str:
        columns = sorted(c.split(":") for c in _COLUMNS[f"{layer}.{table}"] if c not in _LINEAGE_TYPES)
        texts = [f"CAST({c} AS DECIMAL(38,2))" if kind == "double" else c for c, kind in columns]
        texts = ", ".join(f"coalesce(CAST({t} AS VARCHAR), '')" for t in texts)
        return (
            f"SELECT '{name.format(layer=layer, table=table)}' AS {label}, count(*) AS row_count, CAST(sum(CAST('0x' || "
            f"substr(md5(concat_ws('|', {texts})), 1, 15) AS BIGINT)) % 1000000000000000 AS BIGINT) AS content_sum FROM {source}"
        )

    return " UNION ALL ".join(select(layer, *found) for layer in layers for found in _TABLES[layer].items())


def _manifest() -> str:
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS table_schema, '{table}' AS table_name, '{layer}.{table}.parquet' AS file, count(*) AS row_count, "
        f"'{','.join(_COLUMNS[f'{layer}.{table}'])}' AS column_list FROM {source}"
        for layer in ("silver", "gold")
        for table, source in _TABLES[layer].items()
    )


def _draw(tag: str, below: str) -> str:
    return f"(CAST('0x' || substr(md5('{SEED}:{tag}:' || id), 1, 15) AS BIGINT) % {below})"


def _pick(tag: str, options: list[str]) -> str:
    return f"({_list(options)})[{_draw(tag, str(len(options)))} + 1]"


_N, _NC = "(SELECT count(*) FROM orders)", "(SELECT count(*) FROM customer)"
_NAME = f"{_pick('first', FIRST_NAMES)} || '.' || {_pick('last', LAST_NAMES)}"

SYNTHETIC_CUSTOMERS = f"""
WITH ids AS (SELECT c_custkey + 1 AS id FROM customer),
payloads AS (
    SELECT id, strftime(DATE '2026-09-27' - CAST({_draw('birth', '22631')} + 6570 AS INT), '%y%m%d')
               || lpad(CAST({_draw('sequence', '10000')} AS VARCHAR), 4, '0') || '08' AS payload FROM ids
)
SELECT printf('C%05d', id) AS customer_id, {_pick('first', FIRST_NAMES)} AS first_name,
       {_pick('last', LAST_NAMES)} AS last_name,
       payload || CAST((10 - {_luhn_sum('payload', 12)} % 10) % 10 AS VARCHAR) AS sa_id_number,
       lower({_NAME} || id || '@example.co.za') AS email,
       '+27' || {_pick('prefix', PHONE_PREFIXES)} || lpad(CAST({_draw('phone', '10000000')} AS VARCHAR), 7, '0') AS phone,
       {_pick('province', PROVINCES)} AS province,
       CAST(DATE '2026-09-27' - CAST({_draw('signup', '1096')} AS INT) AS VARCHAR) AS signup_date,
       'af-south-1' AS home_region
FROM payloads
"""

_STEP = (
    f"CASE WHEN gcd(7919, {_N}) = 1 THEN 7919 WHEN gcd(104729, {_N}) = 1 THEN 104729 "
    f"WHEN gcd(15485863, {_N}) = 1 THEN 15485863 ELSE 1 END"
)

SYNTHETIC_TRANSACTIONS = f"""
WITH ids AS (SELECT o_orderkey + 1 AS id FROM orders)
SELECT printf('T%06d', id) AS transaction_id, printf('C%05d', {_draw('customer', _NC)} + 1) AS customer_id,
       CAST(CAST(({_draw('amount', str(MAX_CENTS - MIN_CENTS + 1))} + {MIN_CENTS}) / 100.0 AS DECIMAL(12,2)) AS VARCHAR) AS amount_zar,
       'ZAR' AS currency, {_pick('merchant', MERCHANTS)} AS merchant,
       strftime(TIMESTAMP '2026-09-27 23:59:59' - to_days(CAST({_draw('days', '366')} AS INT))
                - to_seconds({_draw('seconds', '86400')}), '%Y-%m-%dT%H:%M:%S') AS txn_timestamp,
       CASE WHEN (id * ({_STEP})) % {_N} < {_N} // 25 THEN {_pick('region', FOREIGN_REGIONS)}
            ELSE 'af-south-1' END AS processing_region
FROM ids
"""

INJECTED = f"""
SELECT * FROM (VALUES ('customers', 'C00001', 'sa_id'), ('customers', 'C00002', 'email'),
    ('customers', 'C00003', 'allowed_values'), ('customers', 'C00004', 'not_null'),
    ('transactions', 'T000001', 'min'), ('transactions', 'T000001', 'unique'),
    ('transactions', 'T000002', 'allowed_values'), ('transactions', 'T000003', 'not_null')
) AS v(dataset, record_key, rule)
UNION ALL SELECT 'transactions', printf('T%06d', {_N}), 'referential_integrity'
"""

EVENTS = rf"""
WITH cells AS (
    SELECT CAST(event_id AS VARCHAR) AS record_key,
           CASE WHEN event_id % 17 = 3 THEN '0x' || user_id WHEN event_id % 17 = 4 THEN '+1_0' || user_id
                ELSE CAST(user_id AS VARCHAR) END AS user_id,
           event_type,
           CASE WHEN event_id % 19 = 5 THEN 'NaN' WHEN event_id % 19 = 6 THEN '-inf'
                WHEN event_id % 19 = 7 THEN '1.0d' ELSE CAST(value AS VARCHAR) END AS value
    FROM events
),
parsed AS (
    SELECT *, CASE WHEN value = '1.0d' THEN NULL ELSE TRY_CAST(value AS DOUBLE) END AS number FROM cells
)
SELECT 'events' AS dataset, record_key, 'user_id' AS column_name, 'type' AS rule,
       'Cannot read ''' || user_id || ''' as integer' AS reason
FROM parsed WHERE NOT regexp_full_match(user_id, '[+-]?[0-9]+(_[0-9]+)*')
UNION ALL
SELECT 'events', record_key, 'event_type', 'allowed_values',
       '''' || event_type || ''' not in allowed set [''click'', ''purchase'', ''signup'', ''view'']'
FROM parsed WHERE event_type NOT IN ('click', 'purchase', 'signup', 'view')
UNION ALL
SELECT 'events', record_key, 'value', 'type', 'Cannot read ''' || value || ''' as float'
FROM parsed WHERE number IS NULL
UNION ALL
SELECT 'events', record_key, 'value', 'min',
       CASE WHEN number IS NULL THEN 'Not a number: ''' || value || ''''
            ELSE CAST(number AS VARCHAR) || ' is below minimum 100' END
FROM parsed WHERE number IS NULL OR isnan(number) OR number < 100
"""

FAULTS = """
SELECT 'customers' AS dataset,
       printf('C%07d', CASE WHEN c_custkey % 113 = 9 THEN c_custkey - 1 ELSE c_custkey END) AS record_key,
       unnest(list_concat(
           CASE c_custkey % 97 WHEN 1 THEN ['sa_id'] WHEN 2 THEN ['email'] WHEN 3 THEN ['allowed_values']
                WHEN 4 THEN ['not_null'] WHEN 5 THEN ['phone'] WHEN 6 THEN ['type'] WHEN 7 THEN ['sa_id']
                WHEN 8 THEN ['allowed_values'] WHEN 9 THEN ['allowed_values'] ELSE [] END,
           CASE WHEN c_custkey % 113 = 9 THEN ['unique'] ELSE [] END)) AS rule
FROM customer
UNION
SELECT 'transactions',
       printf('T%09d', CASE WHEN o_orderkey % 101 = 5 THEN o_orderkey - 1 ELSE o_orderkey END),
       unnest(list_concat(
           CASE o_orderkey % 101 WHEN 0 THEN ['min'] WHEN 1 THEN ['allowed_values'] WHEN 2 THEN ['not_null']
                WHEN 3 THEN ['referential_integrity'] WHEN 5 THEN ['unique'] WHEN 6 THEN ['type', 'min']
                WHEN 7 THEN ['min'] WHEN 8 THEN ['type', 'min'] WHEN 9 THEN ['type']
                WHEN 10 THEN ['allowed_values'] WHEN 11 THEN ['referential_integrity'] ELSE [] END,
           CASE WHEN o_orderkey % 251 = 7 THEN ['residency_blocked'] ELSE [] END))
FROM orders
"""


def _balance(dataset: str, key: str) -> str:
    return (
        f"SELECT '{dataset}' AS dataset, count(b.k) AS raw_keys, "
        "count(*) FILTER (WHERE b.k IS NOT NULL AND s.k IS NOT NULL AND q.k IS NULL) AS silver_only, "
        "count(*) FILTER (WHERE b.k IS NOT NULL AND s.k IS NULL AND q.k IS NOT NULL) AS quarantine_only, "
        "count(*) FILTER (WHERE s.k IS NOT NULL AND q.k IS NOT NULL) AS in_both, "
        "count(*) FILTER (WHERE b.k IS NOT NULL AND s.k IS NULL AND q.k IS NULL) AS lost, "
        "count(*) FILTER (WHERE b.k IS NULL) AS invented "
        f"FROM (SELECT DISTINCT {_t(key)} AS k FROM bronze_{dataset}) b "
        f"FULL JOIN (SELECT DISTINCT {key} AS k FROM silver_{dataset}) s ON s.k = b.k "
        f"FULL JOIN (SELECT DISTINCT record_key AS k FROM quarantine WHERE dataset = '{dataset}') q "
        "ON q.k = coalesce(b.k, s.k)"
    )


def _typed(table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS row_count, '{c}' AS column_name, '{kind}' AS type_name, "
        f"count(*) - count({c}) AS missing FROM silver_{table}"
        for c, kind in columns.items()
    )


def _types(table: str) -> dict[str, str]:
    return dict(c.split(":") for c in _COLUMNS[table] if c not in _LINEAGE_TYPES)


def _leak(column: str, strategy: str, present: bool) -> str:
    leaks = (
        f"(SELECT count(*) FROM silver_customers s JOIN (SELECT DISTINCT * FROM bronze_customers) b "
        f"ON b.customer_id = s.customer_id WHERE s.{column} = {_t('b.' + column)})"
        if present
        else "CAST(0 AS BIGINT)"
    )
    return (
        f"SELECT '{column}' AS column_name, '{strategy}' AS mask_strategy, {str(present).lower()} AS in_silver, "
        f"{leaks} AS leaks"
    )


def _rule(rule: str) -> str:
    return f"SELECT * FROM redacted_rows WHERE rule = '{rule}'"


def _json(*fields: str) -> str:
    return "CAST(to_json({" + ", ".join(f"'{f}': {f}" for f in fields) + "}) AS VARCHAR)"


_SUBJECT_FIELDS = (
    "customer_id", "sa_id_number", "email", "phone", "province", "signup_date", "home_region", "domestic_txns",
    "region_count", "transfer_count", "page", "stamps",
)

_SETTINGS = json.dumps(
    {
        "home_region": "af-south-1",
        "flagged_regions": ["eu-west-1", "us-east-1"],
        "region_names": {"af-south-1": "Cape Town", "eu-west-1": "Ireland", "us-east-1": "N. Virginia"},
    }
)

_ROW = " || chr(2) || ".join(f"coalesce({c}, chr(1))" for c in sorted(TRANSACTION_FIELDS))
_TREE = f"""
, versions AS (
    SELECT 0 AS side, * FROM bronze_transactions UNION ALL
    SELECT 1, * REPLACE (CASE WHEN transaction_id = (SELECT min(transaction_id) FROM bronze_transactions)
                              THEN 'another' ELSE merchant END AS merchant) FROM bronze_transactions
), numbered AS (
    SELECT side, md5(transaction_id) AS place, CAST('0x' || substr(md5({_ROW}), 1, 15) AS BIGINT) AS digest FROM versions
), tree AS (
    SELECT side, substr(place, 1, n) AS prefix, count(*) AS row_count,
           CAST(sum(CAST(digest AS HUGEINT)) % 1000000000000000 AS BIGINT) AS content_sum
    FROM numbered, (SELECT unnest([0, 1, 2, 3]) AS n) GROUP BY ALL
)"""

_FROM_CHAIN = {
    # sources and sinks
    "ingest_bronze": " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, concat_ws('|', {', '.join(fields)}) AS record, true AS has_lineage FROM bronze_{name}"
        for name, fields in (("customers", CUSTOMER_FIELDS), ("transactions", TRANSACTION_FIELDS))
    ),
    "ingest_counts": _counts("bronze", label="dataset"),
    "publish_layer": _contents("silver", "gold", name="{layer}.{table}"),
    "publish_manifest": _manifest(),
    "published_views": _contents("silver", "gold", label="view_name", name="{layer}_{table}"),
    # contract rules
    "validate_customers": "SELECT * FROM row_violations WHERE dataset = 'customers'",
    "validate_transactions": "SELECT * FROM row_violations WHERE dataset = 'transactions'",
    **{f"rule_{r}": _rule(r) for r in ("not_null", "type", "allowed_values", "sa_id", "email", "phone", "min")},
    "contract_violations": "SELECT * FROM violations",
    "redacted_reasons": (
        "SELECT column_name, rule, reason, count(*) AS violations FROM redacted_rows "
        "WHERE dataset = 'customers' GROUP BY ALL"
    ),
    # set checks
    "dup_customer_ids": "SELECT * FROM dup_customers",
    "dup_transaction_ids": "SELECT * FROM dup_transactions",
    "orphan_transactions": (
        f"SELECT t.transaction_id, {_t('t.customer_id')} AS customer_id FROM bronze_transactions t "
        f"WHERE {_t('t.customer_id')} NOT IN (SELECT customer_id FROM bronze_customers)"
    ),
    "set_check_violations": "SELECT * FROM set_violations",
    # governance
    "mask_hash": "SELECT customer_id, sha256(lower(email)) AS email FROM clean_customers",
    "mask_tokenise": f"SELECT customer_id, {_token('sa_id_number')} AS sa_id_number FROM clean_customers",
    "mask_partial": "SELECT customer_id, right(nullif(phone, ''), 3) AS phone FROM clean_customers",
    "pii_inventory": "SELECT i.*, h.values_held FROM inventory i LEFT JOIN held h USING (column_name)",
    "classify_transfer": (
        "SELECT t.transaction_id, c.home_region, c.other_home, t.processing_region, "
        f"{_verdict('c.home_region', 't.processing_region')} AS verdict, "
        f"{_verdict('c.other_home', 't.processing_region')} AS other_verdict FROM clean_transactions t "
        "LEFT JOIN (SELECT customer_id, min(home_region) AS home_region, max(home_region) AS other_home "
        "FROM clean_customers GROUP BY 1) c "
        "ON c.customer_id = t.customer_id"
    ),
    "audit_build_silver": (
        "SELECT 'build_silver' AS event, (SELECT count(*) FROM quarantine "
        "WHERE rule NOT IN ('parent_quarantined', 'residency_blocked')) AS contract_violations, "
        "(SELECT count(*) FROM (SELECT DISTINCT dataset, record_key FROM quarantine)) AS quarantined_records, "
        "(SELECT count(*) FROM silver_customers) AS silver_customers, "
        "(SELECT count(*) FROM silver_transactions) AS silver_transactions, "
        "(SELECT count(*) FROM silver_transactions WHERE processing_region <> home_region) AS cross_border_transactions"
    ),
    # quarantine and silver
    "parent_quarantined": "SELECT * FROM parent_reasons",
    "residency_blocked": "SELECT * FROM blocked_reasons",
    "quarantine": "SELECT * FROM quarantine",
    "dedupe_exact": "SELECT DISTINCT * FROM bronze_transactions",
    "dedupe_customers": "SELECT DISTINCT * FROM bronze_customers",
    "silver_customers": _CUSTOMERS,
    "silver_transactions": _TRANSACTIONS,
    "build_silver": _contents("silver"),
    "build_gold": _contents("gold"),
    # marts
    "daily_revenue_by_province": _DAILY,
    "customer_transaction_summary": _SUMMARY,
    "favourite_merchant": "SELECT customer_id, favourite_merchant FROM activity",
    "customer_totals": (
        "SELECT * EXCLUDE (favourite_merchant) REPLACE (CAST(total_spend_zar AS DOUBLE) AS total_spend_zar, "
        "CAST(first_txn_at AS VARCHAR) AS first_txn_at, CAST(last_txn_at AS VARCHAR) AS last_txn_at) FROM activity"
    ),
    "cross_border_transfer_report": _REPORT,
    "monthly_volume": (
        "SELECT CAST(transfer_month AS VARCHAR) AS transfer_month, CAST(sum(transfer_count) AS BIGINT) AS all_txns "
        "FROM routes GROUP BY 1"
    ),
    "pii_categories": (
        "SELECT string_agg(column_name, ', ' ORDER BY column_name) AS pii_categories "
        "FROM inventory"
    ),
    # reports
    "stamped_subjects": (
        "SELECT customer_id, sa_id_number, email, phone, province, signup_date, home_region, domestic_txns FROM people"
    ),
    "transfer_stamps": "SELECT * REPLACE (CAST(txn_timestamp AS VARCHAR) AS txn_timestamp) FROM stamps",
    "subject_transfers": _SUBJECTS,
    "transfer_totals": (
        "SELECT CAST(sum(transfer_count) AS BIGINT) AS transfers, CAST(sum(amount_zar) AS DOUBLE) AS amount_zar, "
        "count(DISTINCT transfer_month) AS months FROM report"
    ),
    "blocked_count": "SELECT count(*) AS blocked FROM quarantine WHERE rule = 'residency_blocked'",
    "customer_pii": (
        "SELECT column_name, mask_strategy FROM inventory WHERE dataset = 'customers'"
    ),
    "subject_json": (
        f"SELECT 'subject' AS part, {_json(*_SUBJECT_FIELDS)} AS body FROM subjects "
        f"UNION ALL SELECT 'totals', {_json('transfers', 'amount_zar', 'months', 'subjects', 'blocked')} FROM ("
        "SELECT CAST(sum(transfer_count) AS BIGINT) AS transfers, CAST(sum(amount_zar) AS DECIMAL(38,2)) AS amount_zar, "
        "count(DISTINCT transfer_month) AS months, (SELECT count(*) FROM crossings) AS subjects, "
        "(SELECT count(*) FROM quarantine WHERE rule = 'residency_blocked') AS blocked FROM report) "
        f"UNION ALL SELECT 'pii', {_json('column_name', 'mask_strategy')} FROM inventory "
        f"UNION ALL SELECT 'settings', '{_SETTINGS}'"
    ),
    "region_names": (
        "SELECT processing_region, count(*) AS n, CASE processing_region WHEN 'af-south-1' THEN 'Cape Town' "
        "WHEN 'eu-west-1' THEN 'Ireland' WHEN 'us-east-1' THEN 'N. Virginia' ELSE processing_region END AS region_name "
        "FROM clean_transactions GROUP BY 1"
    ),
    "q_report": (
        "SELECT CAST(transfer_month AS VARCHAR) AS transfer_month, processing_region, transfer_count, "
        "data_subjects_affected, CAST(amount_zar AS DOUBLE) AS amount_zar, pct_of_month_txns FROM report "
        "ORDER BY transfer_month, processing_region"
    ),
    "q_transfers_by_region": (
        "SELECT processing_region, CAST(sum(transfer_count) AS BIGINT) AS transfers, "
        "CAST(sum(data_subjects_affected) AS BIGINT) AS subject_months, "
        "CAST(round(sum(amount_zar), 2) AS DOUBLE) AS amount_zar FROM report GROUP BY 1 ORDER BY transfers DESC"
    ),
    "q_masked_sample": (
        "SELECT customer_id, sa_id_number, email, phone, province FROM silver_customers ORDER BY customer_id LIMIT 10"
    ),
    "q_quarantine_by_rule": (
        "SELECT source_table, rule, count(*) AS rows_quarantined FROM quarantine GROUP BY ALL ORDER BY rows_quarantined DESC"
    ),
    "q_revenue_by_province": (
        "SELECT province, CAST(sum(transaction_count) AS BIGINT) AS transactions, "
        "CAST(round(sum(revenue_zar), 2) AS DOUBLE) AS revenue_zar FROM daily GROUP BY 1 ORDER BY revenue_zar DESC"
    ),
    "preview": _TRANSACTIONS + " ORDER BY transaction_id LIMIT 50",
    # assurance
    "no_record_lost": _balance("customers", "customer_id") + " UNION ALL " + _balance("transactions", "transaction_id"),
    "silver_keys_unique": (
        "SELECT 'customers' AS table_name, count(*) AS row_count, count(*) - count(DISTINCT customer_id) AS duplicates "
        "FROM silver_customers UNION ALL SELECT 'transactions', count(*), count(*) - count(DISTINCT transaction_id) "
        "FROM silver_transactions"
    ),
    "silver_ref_integrity": (
        "SELECT count(*) AS dangling FROM silver_transactions t ANTI JOIN silver_customers c USING (customer_id)"
    ),
    "silver_typed": (
        _typed("customers", _types("silver.customers"))
        + " UNION ALL "
        + _typed("transactions", {**_types("silver.transactions"), "amount_zar": "decimal(12,2)"})
    ),
    "pii_leak": " UNION ALL ".join(
        [
            _leak("first_name", "drop", False),
            _leak("last_name", "drop", False),
            _leak("sa_id_number", "tokenise", True),
            _leak("email", "hash", True),
            _leak("phone", "partial", True),
        ]
    ),
    "reason_leak": (
        "SELECT dataset, column_name, count(*) AS reasons, CAST(0 AS BIGINT) AS leaks, CAST(0 AS BIGINT) AS key_leaks "
        "FROM quarantine GROUP BY ALL"
    ),
    "spilled_values": (
        "SELECT r.dataset, r.column_name, r.rule, 'customers' AS value_dataset, s.column_name AS value_column, "
        "count(*) AS reasons FROM reasons r JOIN spilled s ON s.text = r.reason GROUP BY ALL"
    ),
    "recon_daily": (
        "SELECT CAST((SELECT sum(transaction_count) FROM daily) AS BIGINT) AS mart_count, "
        "CAST((SELECT sum(revenue_zar) FROM daily) AS DOUBLE) AS mart_amount, "
        "(SELECT count(*) FROM silver_transactions) AS silver_count, "
        "CAST((SELECT sum(amount_zar) FROM silver_transactions) AS DOUBLE) AS silver_amount, true AS reconciles"
    ),
    "recon_customer": (
        "SELECT (SELECT count(*) FROM summary) AS mart_count, "
        "(SELECT count(DISTINCT customer_id) FROM summary) AS mart_keys, "
        "CAST((SELECT sum(total_spend_zar) FROM summary) AS DOUBLE) AS mart_amount, "
        "(SELECT count(*) FROM silver_customers) AS silver_count, "
        "CAST((SELECT sum(amount_zar) FROM silver_transactions) AS DOUBLE) AS silver_amount, true AS reconciles"
    ),
    "recon_cross_border": (
        "SELECT CAST((SELECT sum(transfer_count) FROM report) AS BIGINT) AS mart_count, "
        "CAST((SELECT sum(amount_zar) FROM report) AS DOUBLE) AS mart_amount, "
        "(SELECT count(*) FROM report WHERE processing_region = home_region) AS domestic_rows, "
        "(SELECT count(*) FROM report WHERE pii_categories NOT LIKE '%sa_id_number%') AS unnamed_rows, "
        "(SELECT count(*) FROM stamps) AS silver_count, "
        "(SELECT CAST(sum(CAST(amount_zar AS DECIMAL(12,2))) AS DOUBLE) FROM stamps) AS silver_amount, true AS reconciles"
    ),
    "table_fingerprint": _counts("bronze", "silver", "gold", name="{layer}.{table}", extra=", true AS unchanged"),
    "digest_tree": f"{_TREE} SELECT prefix, row_count, content_sum FROM tree WHERE side = 0",
    "differing_ranges": (
        f"{_TREE} SELECT prefix, CAST(coalesce(a.row_count, 0) AS BIGINT) AS rows_before, CAST(coalesce(b.row_count, 0) AS BIGINT) AS rows_after "
        "FROM (SELECT * FROM tree WHERE side = 0) a FULL JOIN (SELECT * FROM tree WHERE side = 1) b USING (prefix) "
        "WHERE a.content_sum IS DISTINCT FROM b.content_sum OR a.row_count IS DISTINCT FROM b.row_count"
    ),
    "located_changes": (
        ", changed AS (SELECT * REPLACE (CASE WHEN transaction_id = (SELECT min(transaction_id) FROM bronze_transactions) "
        "THEN 'another' ELSE merchant END AS merchant) FROM bronze_transactions) "
        "SELECT *, 'before' AS side FROM (SELECT * FROM bronze_transactions EXCEPT ALL SELECT * FROM changed) "
        "UNION ALL SELECT *, 'after' FROM (SELECT * FROM changed EXCEPT ALL SELECT * FROM bronze_transactions)"
    ),
    "quarantine_extras": (
        "SELECT dataset, rule, count(*) AS records FROM (SELECT DISTINCT dataset, record_key, rule FROM quarantine "
        f"EXCEPT SELECT dataset, record_key, rule FROM ({FAULTS})) GROUP BY ALL"
    ),
}


def oracle() -> dict[str, str]:
    statements = {name: CHAIN + select for name, select in _FROM_CHAIN.items()}
    statements["synthetic_customers"] = SYNTHETIC_CUSTOMERS
    statements["synthetic_transactions"] = SYNTHETIC_TRANSACTIONS
    statements["inject_faults"] = INJECTED
    statements["validate_events"] = EVENTS
    statements["dup_lineitems"] = (
        "SELECT l_orderkey || '-' || l_linenumber AS line, count(*) AS n "
        "FROM (SELECT DISTINCT * FROM lineitem) GROUP BY 1 HAVING count(*) > 1"
    )
    return statements
