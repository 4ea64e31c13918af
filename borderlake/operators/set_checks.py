"""Checks that look across rows: copies, conflicting keys, dangling references."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from borderlake.operators.contracts import (
    LINEAGE,
    Check,
    emit,
    foreign_keys,
    normalise_keys,
    pii_columns,
    redaction,
)
from borderlake.operators.skew import count_keys, sliced_join

UNIQUE = "unique"
REFERENTIAL = "referential_integrity"


def collapse_copies(table: DataFrame) -> DataFrame:
    """One row per distinct payload; a re-delivered copy keeps its first lineage.

    Copies are combined before the shuffle, so a row delivered any number of
    times costs each map task one row.
    """
    lineage = [c for c in LINEAGE if c in table.columns]
    payload = [c for c in table.columns if c not in lineage]
    if not lineage:
        return table.distinct()
    return table.groupBy(*payload).agg(*[F.min(c).alias(c) for c in lineage])


def conflicting_keys(unique_rows: DataFrame, *key: str) -> DataFrame:
    """Keys carried by more than one different row, with the number of rows ``n``."""
    return unique_rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_keys(table: DataFrame, contract: dict) -> DataFrame:
    """Conflicting primary keys of a raw table. Exact copies are not a conflict."""
    return conflicting_keys(collapse_copies(normalise_keys(table, contract)), contract["primary_key"])


def orphans(children: DataFrame, column: str, parents: DataFrame, parent_column: str) -> DataFrame:
    """Rows of ``children`` whose reference has no parent row at all."""
    known = parents.select(F.col(parent_column).alias(column)).distinct()
    dangling = children.select(column).distinct().join(known, column, "left_anti")
    counts = count_keys(children, column).join(dangling, column, "left_semi")
    return sliced_join(children, dangling, column, "left_semi", counts)


def unique_check(contract: dict, versions: Column) -> Check:
    """The primary key has ``versions`` different rows."""
    key = contract["primary_key"]

    def reason() -> Column:
        return F.concat(F.lit(f"{key} appears "), versions.cast("string"), F.lit(" times"))

    return _check(contract, key, UNIQUE, versions > 1, reason)


def reference_check(contract: dict, column: str, parent: str, dangling: Column) -> Check:
    def reason() -> Column:
        return F.concat(F.lit(f"{column} '"), F.col(column), F.lit(f"' not found in {parent}"))

    return _check(contract, column, REFERENTIAL, dangling, reason)


def _check(contract: dict, column: str, rule: str, broken: Column, reason: Callable[[], Column]) -> Check:
    return Check(column, rule, broken, redaction(rule) if column in pii_columns(contract) else reason)


def set_check_violations(tables: dict[str, DataFrame], contracts: dict[str, dict]) -> DataFrame:
    """All set checks the contracts declare: unique primary keys and references."""
    found = []
    clean = {name: normalise_keys(table, contracts[name]) for name, table in tables.items()}
    for name, contract in contracts.items():
        key = contract.get("primary_key")
        if key in clean[name].columns:
            conflicts = conflicting_keys(collapse_copies(clean[name]), key)
            found.append(emit(conflicts, contract, [unique_check(contract, F.col("n"))]))
        for column, parent, parent_column in foreign_keys(contract):
            children = clean[name].select(*[c for c in dict.fromkeys((key, column)) if c in clean[name].columns])
            dangling = orphans(children, column, clean[parent], parent_column)
            found.append(emit(dangling, contract, [reference_check(contract, column, parent, F.lit(True))]))
    return union(found)


def union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
