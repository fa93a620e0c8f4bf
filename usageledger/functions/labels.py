"""Usage type labels: overage labels fold into the label of the service."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Services that also appear with an "overage-" prefix.
OVERAGE_SERVICES = (
    "automatic clustering",
    "cloud services",
    "compute",
    "snowpipe",
    "materialized views",
    "search optimization",
    "serverless tasks",
    "replication",
    "storage",
)
ADJUSTMENT = "adj for incl cloud services"

#: Price lists keep the cloud adjustment as its own label.
RATE_LABELS = {f"overage-{s}": s for s in (*OVERAGE_SERVICES, ADJUSTMENT)}
#: Spending reports count the cloud adjustment as cloud services.
SPEND_LABELS = {
    **{f"overage-{s}": s for s in OVERAGE_SERVICES},
    ADJUSTMENT: "cloud services",
    f"overage-{ADJUSTMENT}": "cloud services",
}


def normalize_usage_type(usage_type: Column, labels: dict[str, str]) -> Column:
    """Replace known labels; all others stay as they are."""
    mapping = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.try_element_at(mapping, usage_type), usage_type)
