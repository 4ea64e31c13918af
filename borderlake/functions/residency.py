"""The residency verdict of a record: where it lives against where it was processed."""

from __future__ import annotations

from importlib.resources.abc import Traversable
from pathlib import Path

import yaml
from pyspark.sql import Column
from pyspark.sql import functions as F

DOMESTIC = "domestic"
FLAGGED = "cross_border_flagged"
BLOCKED = "blocked"
PERMITTED = (DOMESTIC, FLAGGED)
VERDICTS = (DOMESTIC, FLAGGED, BLOCKED)


def load_policy(path: str | Path | Traversable) -> dict:
    """Read a policy file. The verdict for unknown regions must not fail open."""
    policy = yaml.safe_load((Path(path) if isinstance(path, str) else path).read_text(encoding="utf-8")) or {}
    unknown = policy.get("on_unknown_region", BLOCKED)
    if unknown not in (BLOCKED, FLAGGED):
        raise ValueError(f"on_unknown_region must be {BLOCKED} or {FLAGGED}, not {unknown!r}")
    return policy


def classify_transfer(home: Column, processing: Column, policy: dict) -> Column:
    """Verdict for one record; NULL when either region is NULL."""
    return (
        F.when(home.isNull() | processing.isNull(), F.lit(None).cast("string"))
        .when(processing == home, F.lit(DOMESTIC))
        .when(processing.isin(policy.get("allowed_regions") or []), F.lit(DOMESTIC))
        .when(processing.isin(policy.get("flagged_regions") or []), F.lit(FLAGGED))
        .otherwise(F.lit(policy.get("on_unknown_region", BLOCKED)))
    )


# Display names of the regions in use.
REGION_NAMES = {
    "af-south-1": "Cape Town",
    "eu-west-1": "Ireland",
    "us-east-1": "N. Virginia",
}


def region_name(region: Column) -> Column:
    """Display name of a region, or its code where none is known."""
    names = F.create_map(*[F.lit(text) for pair in REGION_NAMES.items() for text in pair])
    return F.coalesce(F.try_element_at(names, region), region)
