"""The whole build: deliveries to bronze, silver and gold, with an audit entry.

The script ``lakehouse.py`` at the top of the repository starts it.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from borderlake.functions.mask import secret_key
from borderlake.functions.residency import load_policy
from borderlake.operators.contracts import GOVERNANCE, Folder, folder, load_contracts, pii_inventory
from borderlake.operators.gold import build_gold, crossed
from borderlake.operators.judge import judge, quarantine
from borderlake.operators.silver import silver_customers, silver_transactions
from borderlake.plans.audit import audit_details, record
from borderlake.sources.delivery import load_csv
from borderlake.sources.lake import Lake, side_by_side

log = logging.getLogger(__name__)


# One shuffle partition per this many input bytes.
SHUFFLE_BYTES = 256 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def sized_shuffles(spark: SparkSession, paths: list[str]) -> Iterator[int]:
    """Let shuffles start with partitions to suit the input, unless the session says how many.

    The default of 200 would leave each with terabytes on a large delivery.
    Adaptive execution merges those that turn out small. The setting holds for one
    run. Gives the number of partitions shuffles start with.
    """
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = spark.conf.get(INITIAL_PARTITIONS, None)
    if own:
        yield int(own)
        return
    conf, size = spark._jsc.hadoopConfiguration(), 0
    for path in paths:
        pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = pattern.getFileSystem(conf)
        size += sum(files.getContentSummary(found.getPath()).getLength() for found in files.globStatus(pattern) or [])
    wanted = max(usual, size // SHUFFLE_BYTES + 1)
    spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    try:
        yield wanted
    finally:
        spark.conf.unset(INITIAL_PARTITIONS)


def ingest(lake: Lake, deliveries: dict[str, str]) -> dict[str, int]:
    """Load each delivery into its bronze table; gives the row counts."""
    loaded_at = datetime.now(timezone.utc).isoformat()

    def load(name: str) -> int:
        return lake.load("bronze", name, partial(load_csv, lake.spark, deliveries[name], loaded_at))

    with lake.build():
        counts = side_by_side(lake.spark, [partial(load, name) for name in deliveries])
    return dict(zip(deliveries, counts, strict=True))


def transform(lake: Lake, contracts: dict[str, dict], policy: dict, key: str | None = None) -> dict[str, int]:
    """Bronze to silver and gold, all of which become current together. Each step is stored,
    so a lost executor costs a few tasks and never an earlier step."""
    key = secret_key(key)  # fail before any work is done
    with lake.build():
        details = _transform(lake, contracts, policy, key)
    record(lake, "build_silver", details)
    return details


def _transform(lake: Lake, contracts: dict[str, dict], policy: dict, key: str) -> dict[str, int]:
    def keep(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        jobs = [partial(lake.replace, frame, "staging", name) for name, frame in frames.items()]
        return dict(zip(frames, (table for table, _ in side_by_side(lake.spark, jobs)), strict=True))

    bronze = {name: lake.table("bronze", name) for name in contracts}
    judged = judge(bronze, contracts, keep)
    (rejected, _), (inventory, _), (customers, kept), (transactions, moved) = side_by_side(
        lake.spark,
        [
            lambda: lake.replace(
                quarantine(judged, contracts, policy), "silver", "quarantine", partition_by=("dataset",)
            ),
            lambda: lake.replace(pii_inventory(lake.spark, contracts).coalesce(1), "silver", "pii_inventory"),
            lambda: lake.replace(
                silver_customers(judged["customers"], contracts["customers"], key), "silver", "customers"
            ),
            lambda: lake.replace(
                silver_transactions(judged["transactions"], contracts["transactions"], policy),
                "silver",
                "transactions",
                crossings=F.count_if(crossed()),
            ),
        ],
    )
    details = {
        **audit_details(rejected).first().asDict(),
        "silver_customers": kept["rows"],
        "silver_transactions": moved["rows"],
        "cross_border_transactions": moved["crossings"],
    }
    silver = {"customers": customers, "transactions": transactions, "pii_inventory": inventory}
    marts = build_gold(silver)
    side_by_side(lake.spark, [partial(lake.replace, mart, "gold", name) for name, mart in marts.items()])
    return details


def run(
    lake: Lake,
    deliveries: dict[str, str],
    governance: Folder = GOVERNANCE,
    key: str | None = None,
) -> dict[str, int]:
    """Build everything from the deliveries. Running it again gives the same tables. Readers
    see the tables of the build before until all of this one are there."""
    contracts = load_contracts(governance)
    policy = load_policy(folder(governance) / "residency.yml")
    key = secret_key(key)
    with sized_shuffles(lake.spark, list(deliveries.values())):
        with lake.build():
            log.info("ingested %s", ingest(lake, deliveries))
            details = _transform(lake, contracts, policy, key)
        record(lake, "build_silver", details)
    return details
