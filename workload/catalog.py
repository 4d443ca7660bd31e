"""All registered queries."""

from workload import aggregation, alerting, axis, cascades, directory, intake, streams, tracking
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "aggregation", "alerting", "axis", "cascades", "directory", "intake", "streams", "tracking"]
