"""The append-only audit trail."""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from borderlake.sources.lake import Lake

log = logging.getLogger(__name__)


def audit_details(quarantine: DataFrame) -> DataFrame:
    """What a silver build rejected: violations of the contracts, and records. Reasons that
    redaction makes the same count once."""
    cascades = ("parent_quarantined", "residency_blocked")
    return quarantine.agg(
        F.count_if(~F.col("rule").isin(*cascades)).alias("contract_violations"),
        F.count_distinct("dataset", "record_key").alias("quarantined_records"),
    )


def record(lake: Lake, event: str, details: dict[str, int]) -> None:
    """Append one event. Nothing is ever overwritten."""
    at = datetime.now(timezone.utc).replace(tzinfo=None)
    entry = lake.spark.createDataFrame(
        [(event, at, {k: int(v) for k, v in details.items()})],
        "event string, at timestamp_ntz, details map<string, bigint>",
    )
    lake.append(entry.coalesce(1), "ops", "audit_log")
    log.info("audit %s %s", event, details)
