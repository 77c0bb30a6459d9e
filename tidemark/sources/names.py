"""Table naming: every table of the product under one (catalog, schema) prefix."""

from __future__ import annotations

from dataclasses import dataclass, field

# The name of the table of each role.
TABLES = {
    "bronze": "bronze_trips",
    "silver": "silver_trips",
    "silver_sketches": "silver_sketches",
    "predictions": "predictions",
    "drift_metrics": "drift_metrics",
    "performance_metrics": "performance_metrics",
    "endpoint_drift_metrics": "endpoint_drift_metrics",
    "request_rejects": "request_rejects",
    "baseline_bins": "baseline_bins",
    "baseline_values": "baseline_values",
    "baseline_sample": "baseline_sample",
    "model_runs": "model_runs",
    "model_versions": "model_versions",
    "model_aliases": "model_aliases",
    "model_signatures": "model_signatures",
    "model_name": "fare_model",
    "payload": "request_log",
}


@dataclass(frozen=True)
class TableNames:
    """Names of all tables of one environment, by role: `names.silver`, `names.payload`.

    `catalog` is optional: a plain session catalog only knows `schema.table` (three-part
    names fail there). `own` replaces names of single roles, e.g. the request log, which
    the serving layer writes and names.
    """

    schema: str
    catalog: str | None = None
    own: dict[str, str] = field(default_factory=dict)

    @property
    def namespace(self) -> str:
        return f"{self.catalog}.{self.schema}" if self.catalog else self.schema

    def __getattr__(self, role: str) -> str:
        if role not in TABLES:
            raise AttributeError(role)
        return f"{self.namespace}.{self.own.get(role, TABLES[role])}"
