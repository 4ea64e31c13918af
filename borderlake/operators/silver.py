"""Silver: fit records, typed, masked and stamped with their residency verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from borderlake.functions.mask import mask
from borderlake.functions.residency import PERMITTED, classify_transfer
from borderlake.functions.rules import active, to_date, to_money, to_timestamp
from borderlake.functions.text import digits_only, number
from borderlake.operators.contracts import LINEAGE
from borderlake.operators.judge import HOME, PARENT_ACCEPTED, accepted


def silver_column(spec: dict, key: str | None = None) -> Column | None:
    """The silver form of a contract column; None for one that must not get there.

    Casts are tolerant because Spark may run them before the rejected rows are
    filtered out; ``assurance.typed_columns`` shows that no fit value is lost.
    """
    name = spec["name"]
    text = F.col(name)
    if spec.get("pii", False):
        strategy = spec.get("mask", "none")
        if strategy == "drop":
            return None
        if active(spec, "email"):
            text = F.lower(text)
        return mask(F.nullif(text, F.lit("")), strategy, key).alias(name)
    kind = spec.get("type")
    if kind == "decimal":
        text = to_money(text)
    elif kind in ("float", "numeric"):
        text = number(text)
    elif kind in ("int", "integer"):
        text = digits_only(text).try_cast("bigint")
    elif kind == "date":
        text = to_date(text)
    elif kind == "timestamp":
        text = to_timestamp(text)
    return text.alias(name)


def projection(contract: dict, key: str | None = None) -> list[Column]:
    columns = (silver_column(spec, key) for spec in contract.get("columns") or [])
    return [c for c in columns if c is not None]


def _lineage(table: DataFrame) -> list[str]:
    return [c for c in LINEAGE if c in table.columns]


def silver_customers(judged: DataFrame, contract: dict, key: str | None = None) -> DataFrame:
    return judged.filter(accepted()).select(*projection(contract, key), *_lineage(judged))


def silver_transactions(judged: DataFrame, contract: dict, policy: dict) -> DataFrame:
    """Fit transactions of accepted customers, in regions the policy permits.

    The judged row says all of it, so nothing is joined here. An accepted
    customer has exactly one row, hence one home.
    """
    verdict = classify_transfer(F.col(HOME), F.col("processing_region"), policy)
    typed = judged.filter(accepted() & F.col(PARENT_ACCEPTED) & verdict.isin(*PERMITTED)).select(
        *projection(contract),
        F.col(HOME).alias("home_region"),
        verdict.alias("residency_status"),
        *_lineage(judged),
    )
    last = ["home_region", "processing_region", "residency_status", *_lineage(judged)]
    return typed.select(*[c for c in typed.columns if c not in last], *last)
