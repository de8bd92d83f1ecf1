"""Tripmill: periodic file drops turned into clean, accounted-for tables on Spark."""

from tripmill.operators.analyses import hourly_avg, monthly_avg, overall_avg, service_split
from tripmill.operators.conform import conform_union
from tripmill.operators.gold import gold_consumption, gold_trips
from tripmill.operators.profile import (
    amount_profile,
    layer_sizes,
    passenger_profile,
    preview,
    rows_per_key,
    trip_profile,
)
from tripmill.operators.silver import SilverAudit, file_audit, rejected_rows, silver, silver_audit
from tripmill.plans.answers import (
    all_layer_sizes,
    checks,
    hourly_passengers,
    monthly_amounts,
    overall_amount,
    passengers_by_service,
)
from tripmill.plans.medallion import RunReport, bronze, run
from tripmill.plans.refresh import RefreshReport, refresh
from tripmill.sources.drifted import SourceFile, drift_report, scan_conformed
from tripmill.sources.landing import MissingFilesError, landing_status, manifest, require_landing
from tripmill.sources.tables import bootstrap, overwrite_table, read_table, row_count
from tripmill.spec import PipelineSpec, ServiceSpec, TableName, taxi_services

__all__ = [
    "MissingFilesError",
    "PipelineSpec",
    "RefreshReport",
    "RunReport",
    "ServiceSpec",
    "SilverAudit",
    "SourceFile",
    "TableName",
    "all_layer_sizes",
    "amount_profile",
    "bootstrap",
    "bronze",
    "checks",
    "conform_union",
    "drift_report",
    "file_audit",
    "gold_consumption",
    "gold_trips",
    "hourly_avg",
    "hourly_passengers",
    "landing_status",
    "layer_sizes",
    "manifest",
    "monthly_amounts",
    "monthly_avg",
    "overall_amount",
    "overall_avg",
    "overwrite_table",
    "passenger_profile",
    "passengers_by_service",
    "preview",
    "read_table",
    "refresh",
    "rejected_rows",
    "require_landing",
    "row_count",
    "rows_per_key",
    "run",
    "scan_conformed",
    "service_split",
    "silver",
    "silver_audit",
    "taxi_services",
    "trip_profile",
]
