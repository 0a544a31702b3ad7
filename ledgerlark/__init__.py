"""Invoice signals on Spark: lazy DataFrame detectors and the alert table they feed."""

from ledgerlark.functions.dates import Cadence
from ledgerlark.operators.accrual import accrual_alerts
from ledgerlark.operators.alerts import AlertLocation, AlertType, combine, conform
from ledgerlark.operators.cadence import cadence_misses, missing_invoices
from ledgerlark.operators.dormant import dormant_vendors
from ledgerlark.operators.spend import SpendBand, large_months
from ledgerlark.plans.increments import SignalState
from ledgerlark.plans.registry import Signal, register_signal, with_names
from ledgerlark.plans.run import execute_config, run_config, run_signals, shared_invoices
from ledgerlark.schema import (
    ALERT_SCHEMA,
    INVOICE_SPEC,
    LINE_ITEM_SPEC,
    InvoiceColumns,
    TableSpec,
)
from ledgerlark.sources.sinks import read_alerts, write_alerts
from ledgerlark.sources.versions import VersionConflict, VersionedFolder
from ledgerlark.sources.tables import column_kinds, infer_spec, read_typed, read_with_rejects, stage

__all__ = [
    "ALERT_SCHEMA",
    "AlertLocation",
    "AlertType",
    "Cadence",
    "INVOICE_SPEC",
    "InvoiceColumns",
    "LINE_ITEM_SPEC",
    "Signal",
    "SignalState",
    "SpendBand",
    "TableSpec",
    "VersionConflict",
    "VersionedFolder",
    "accrual_alerts",
    "cadence_misses",
    "column_kinds",
    "combine",
    "conform",
    "dormant_vendors",
    "execute_config",
    "infer_spec",
    "large_months",
    "missing_invoices",
    "read_alerts",
    "read_typed",
    "read_with_rejects",
    "register_signal",
    "run_config",
    "run_signals",
    "shared_invoices",
    "stage",
    "with_names",
    "write_alerts",
]
