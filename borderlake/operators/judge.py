"""Judging records: which are fit, and for the others every reason why not.

Each raw table becomes a judged table: its distinct rows, each with what is
known about it. Everything that takes a wide shuffle (copies, conflicting keys,
the customer of a transaction) happens once here; quarantine and silver then
only read judged rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from borderlake.functions.residency import PERMITTED, VERDICTS, classify_transfer
from borderlake.functions.text import cell
from borderlake.operators.contracts import Check, checks, clean_cells, emit, foreign_keys, normalise_keys, row_fits
from borderlake.operators.leaks import personal_values, redact
from borderlake.operators.set_checks import (
    collapse_copies,
    conflicting_keys,
    reference_check,
    union,
    unique_check,
)
from borderlake.operators.skew import count_keys, sliced_join

# What judging adds to a row: does it pass its own rules, how many different
# rows share its key; for transactions also whether the customer is accepted
# (NULL: unknown) and the customer's lowest and highest home region.
FITS, VERSIONS = "_fits", "_versions"
PARENT_ACCEPTED, HOME, OTHER_HOME = "_parent_accepted", "_home", "_other_home"
# A short hash of the primary key, below MARKS, while rows with repeated keys are looked for.
MARK, MARKS = "_mark", 2**31 - 1
JUDGEMENT = (FITS, VERSIONS, PARENT_ACCEPTED, HOME, OTHER_HOME)

Keep = Callable[[dict[str, DataFrame]], dict[str, DataFrame]]


def no_keep(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return frames


def distinct_rows(table: DataFrame, contract: dict) -> DataFrame:
    """Distinct raw rows, then their cells stripped and held against the contract."""
    return judged_cells(collapse_copies(normalise_keys(table, contract)), contract)


def judged_cells(rows: DataFrame, contract: dict) -> DataFrame:
    rows = rows.select(*clean_cells(rows, contract))
    return rows.withColumn(FITS, row_fits(contract, rows.columns))


def mark_of(key: str) -> Column:
    """A short number for a key. Keys may share one, so it only tells which keys may be repeated."""
    return F.pmod(F.xxhash64(cell(key)), F.lit(MARKS)).cast("int")


def repeated_marks(table: DataFrame, contract: dict) -> DataFrame:
    """Marks of the keys that more than one raw row has."""
    keys = table.select(F.xxhash64(cell(contract["primary_key"])).alias("_hash"))
    repeated = keys.groupBy("_hash").agg(F.count("*").alias("n")).filter("n > 1")
    return repeated.select(F.pmod("_hash", F.lit(MARKS)).cast("int").alias(MARK))


def rows_by_mark(table: DataFrame, contract: dict, repeated: DataFrame, how: str) -> DataFrame:
    """The raw rows whose key may be repeated (left_semi), or those whose key is their own (left_anti).

    Where the marks are too many to broadcast, the rows are on the side that adaptive execution
    splits, so a frequent key does not gather in one task."""
    return table.withColumn(MARK, mark_of(contract["primary_key"])).join(repeated, MARK, how).select(*table.columns)


def marked_rows(tables: dict[str, DataFrame], contracts: dict[str, dict], keep: Keep) -> dict[str, DataFrame]:
    """Distinct rows of every dataset, with their own verdict and the number of versions of their key.

    Copies and conflicts share a key. So only hashes of the keys are shuffled for all rows; a row
    whose key no other has is distinct and is passed on as it is read, and the others alone are
    grouped as whole rows and stored. Where nothing is stored, all rows are grouped, as the steps
    would be repeated for each row set that is made from them.
    """

    def kept(label: str, make: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
        found = keep({f"{name}_{label}": make(name) for name in tables})
        return {name: found[f"{name}_{label}"] for name in tables}

    def own(name: str) -> DataFrame:
        rows = rows_by_mark(tables[name], contracts[name], repeated[name], "left_anti")
        return judged_cells(normalise_keys(rows, contracts[name]), contracts[name]).withColumn(VERSIONS, F.lit(1).cast("bigint"))

    keys = {name: contracts[name]["primary_key"] for name in tables}
    if keep is no_keep:
        rows = {name: distinct_rows(tables[name], contracts[name]) for name in tables}
        return {name: mark_conflicts(rows[name], conflicting_keys(rows[name], keys[name]), keys[name]) for name in tables}
    repeated = kept("repeated", lambda name: repeated_marks(tables[name], contracts[name]))
    rows = kept("rows", lambda name: distinct_rows(rows_by_mark(tables[name], contracts[name], repeated[name], "left_semi"), contracts[name]))
    conflicts = kept("conflicts", lambda name: conflicting_keys(rows[name], keys[name]))
    return {name: own(name).unionByName(mark_conflicts(rows[name], conflicts[name], keys[name])) for name in tables}


def mark_conflicts(rows: DataFrame, conflicts: DataFrame, key: str) -> DataFrame:
    marked = sliced_join(rows, conflicts, key, "left", counts=conflicts)
    return marked.withColumn(VERSIONS, F.coalesce("n", F.lit(1))).drop("n")


def accepted() -> Column:
    return F.col(FITS) & (F.col(VERSIONS) == 1)


def customer_standing(customers: DataFrame) -> DataFrame:
    """One row per customer id of the judged customers.

    An id with conflicting rows may have several homes. Lowest and highest are
    enough to tell whether any of them differs from a processing region.
    """
    home = F.col("home_region")
    return customers.groupBy("customer_id").agg(
        F.bool_and(accepted()).alias(PARENT_ACCEPTED),
        F.min(home).alias(HOME),
        F.max(home).alias(OTHER_HOME),
    )


def judge(
    bronze: dict[str, DataFrame], contracts: dict[str, dict], keep: Keep = no_keep
) -> dict[str, DataFrame]:
    """Judged customers and transactions.

    ``keep`` may store the frames of a step, side by side, and hand back the
    stored tables. Stored tables have known sizes, so that Spark broadcasts a
    short list of conflicts or customers from the start instead of shuffling the
    large side first.
    """
    marked = marked_rows({name: bronze[name] for name in ("customers", "transactions")}, contracts, keep)
    customers = keep({"customers_judged": marked["customers"]})["customers_judged"]
    # One customer may own a large part of all transactions, hence the slices;
    # they are counted in one column of the raw rows, copies included.
    owners = normalise_keys(bronze["transactions"], contracts["transactions"])
    found = keep(
        {
            "customer_standing": customer_standing(customers),
            "customer_owners": count_keys(owners, "customer_id"),
        }
    )
    transactions = sliced_join(
        marked["transactions"], found["customer_standing"], "customer_id", "left", found["customer_owners"]
    )
    return {"customers": customers, "transactions": keep({"transactions_judged": transactions})["transactions_judged"]}


def _region() -> Column:
    return F.col("processing_region")


def blocked_verdict(policy: dict) -> Column:
    """The verdict that keeps a judged transaction out, or NULL."""
    verdicts = [classify_transfer(F.col(h), _region(), policy) for h in (HOME, OTHER_HOME)]
    return F.coalesce(*[F.when(~v.isin(*PERMITTED), v) for v in verdicts])


def orphan_check(contract: dict) -> Check:
    return reference_check(contract, "customer_id", "customers", F.col(PARENT_ACCEPTED).isNull())


def parent_check() -> Check:
    """The customer was rejected; silver must stay referentially whole."""

    def reason() -> Column:
        return F.concat(F.lit("customer "), F.col("customer_id"), F.lit(" is quarantined"))

    return Check("customer_id", "parent_quarantined", F.coalesce(~F.col(PARENT_ACCEPTED), F.lit(False)), reason)


def residency_check(policy: dict) -> Check:
    """Processed in a region the policy neither allows nor flags."""
    verdict = blocked_verdict(policy)

    def reason() -> Column:
        return F.concat(F.lit("processing_region "), _region(), F.lit(" -> "), verdict)

    return Check("processing_region", "residency_blocked", verdict.isNotNull(), reason)


def contract_checks(judged: DataFrame, contract: dict) -> list[Check]:
    """Row rules and set checks of a judged table, personal values redacted."""
    payload = [c for c in judged.columns if c not in JUDGEMENT]
    compiled = checks(contract, payload, redact=True)
    compiled.append(unique_check(contract, F.col(VERSIONS)))
    if PARENT_ACCEPTED in judged.columns:
        compiled.append(orphan_check(contract))
    return compiled


def _emit(judged: DataFrame, contract: dict, compiled: list[Check], cascades: list[Check]) -> DataFrame:
    suspect = ~accepted()
    if PARENT_ACCEPTED in judged.columns:
        suspect = suspect | F.col(PARENT_ACCEPTED).isNull()
    for check in cascades:
        suspect = suspect | check.broken
    return emit(judged, contract, compiled + cascades, suspect)


def contract_violations(judged: dict[str, DataFrame], contracts: dict[str, dict]) -> DataFrame:
    return union(
        [_emit(rows, contracts[name], contract_checks(rows, contracts[name]), []) for name, rows in judged.items()]
    )


def parent_quarantined(judged: DataFrame, contract: dict) -> DataFrame:
    return emit(judged, contract, [parent_check()])


def residency_blocked(judged: DataFrame, contract: dict, policy: dict) -> DataFrame:
    return emit(judged, contract, [residency_check(policy)])


def reasons(judged: dict[str, DataFrame], contracts: dict[str, dict], policy: dict) -> DataFrame:
    """One row per reason a record is kept out: one narrow pass over each judged table.

    Personal columns are not quoted; what was typed into other columns is."""
    cascades = {"customers": [], "transactions": [parent_check(), residency_check(policy)]}
    return union(
        [
            _emit(rows, contracts[name], contract_checks(rows, contracts[name]), cascades[name])
            for name, rows in judged.items()
        ]
    )


def wording(spark: SparkSession, contracts: dict[str, dict]) -> DataFrame:
    """What reasons say whatever the value: those of empty cells and of a low number."""
    cells = spark.range(1).select(F.explode(F.array(F.lit(""), F.lit("-1"))).alias("_cell"))
    said = []
    for contract in contracts.values():
        names = [spec["name"] for spec in contract.get("columns") or []]
        rows = cells.select(*[F.col("_cell").alias(n) for n in dict.fromkeys([*names, "customer_id"])])
        compiled = [*checks(contract, names), *checks(contract, names, redact=True), unique_check(contract, F.lit(0))]
        compiled += [reference_check(contract, column, parent, F.lit(True)) for column, parent, _ in foreign_keys(contract)]
        fixed = [c.reason() for c in [*compiled, parent_check()]]
        fixed += [F.lit(f"{parent.removesuffix('s')} is quarantined") for _, parent, _ in foreign_keys(contract)]
        fixed += [F.lit(f"processing_region -> {verdict}") for verdict in VERDICTS]
        said.append(rows.select(F.explode(F.array(*fixed)).alias("text")))
    return union(said)


def quarantine(judged: dict[str, DataFrame], contracts: dict[str, dict], policy: dict) -> DataFrame:
    """One row per reason a record was kept out, with a pointer to the raw table.

    No raw value of a personal column is in it, whichever column it was typed into.
    """
    found = reasons(judged, contracts, policy)
    values = personal_values(judged, contracts)
    clean = found if values is None else redact(found, values, wording(found.sparkSession, contracts))
    return clean.withColumn("source_table", F.concat(F.lit("bronze."), F.col("dataset")))
