"""The detectors by name: the one place to look one up or to add one."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerlark.operators.accrual import accrual_alerts
from ledgerlark.operators import alerts as base
from ledgerlark.operators.alerts import AlertLocation, AlertType
from ledgerlark.operators.cadence import missing_invoices
from ledgerlark.operators.dormant import dormant_vendors
from ledgerlark.operators.spend import large_months


@dataclass(frozen=True)
class Signal:
    """A detector: its function, its codes, and which configuration argument names which table.

    ``takes_rules`` says whether the function has a ``rules`` argument, ``reduces_copies`` whether it
    gives the same for one row per (vendor, invoice, date), with the largest amount and latest end.
    """

    detect: Callable[..., DataFrame]
    alert_type: int
    location: int
    tables: dict[str, str]
    takes_rules: bool = False
    reduces_copies: bool = False


_INVOICES = {"invoice_data_loader": "invoices"}

SIGNALS: dict[str, Signal] = {
    "VendorNotSeenInAWhile": Signal(
        dormant_vendors, AlertType.VendorNotSeenInAWhile, AlertLocation.Invoice, _INVOICES, True, True
    ),
    "AccrualAlert": Signal(
        accrual_alerts,
        AlertType.AccrualAlert,
        AlertLocation.Invoice,
        {**_INVOICES, "line_item_data_loader": "line_items"},
        True,
        True,
    ),
    "LargeMonthIncreaseMtd": Signal(
        large_months, AlertType.LargeMonthIncreaseMtd, AlertLocation.Vendor, _INVOICES, True, True
    ),
    "NoInvoiceReceived": Signal(
        missing_invoices, AlertType.NoInvoiceReceived, AlertLocation.Vendor, _INVOICES, True, True
    ),
}


def register_signal(name: str, signal: Signal) -> None:
    """Add a detector of your own; its type code must be new."""
    if name in SIGNALS or signal.alert_type in {s.alert_type for s in SIGNALS.values()}:
        raise ValueError(f"detector {name!r} or type {signal.alert_type} is already registered")
    SIGNALS[name] = signal


def type_names() -> dict[int, str]:
    """Names of all registered types; a detector of your own goes by its name in lower case with
    underscores between words."""
    return {
        int(signal.alert_type): base.TYPE_NAMES.get(signal.alert_type)
        or re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()
        for name, signal in SIGNALS.items()
    }


def with_names(alerts: DataFrame) -> DataFrame:
    """Replace the type and location codes by their names, those of registered detectors included."""
    return base.with_names(alerts, type_names())
