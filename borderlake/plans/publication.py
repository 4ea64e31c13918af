"""Publishing a built lake: its tables, a manifest, and what a page about transfers shows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from borderlake.operators.reports import TRANSFERS_PER_PAGE, view_payload
from borderlake.sources.lake import Lake, Snapshot
from borderlake.sources.publish import publish


def publish_lake(lake: Lake, policy: dict, target: str, page_size: int = TRANSFERS_PER_PAGE) -> DataFrame:
    """Publish silver and gold under ``target``, with the payload as ``payload.json``; the manifest."""

    def payload(folder: str, build: Snapshot) -> None:
        view_payload(
            lake.spark,
            build.table("silver", "customers"),
            build.table("silver", "transactions"),
            build.table("gold", "cross_border_transfer_report"),
            build.table("silver", "quarantine"),
            build.table("silver", "pii_inventory"),
            policy,
            page_size,
        ).write.json(f"{folder}/payload.json")

    return publish(lake, target, payload)
