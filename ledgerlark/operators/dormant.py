"""Vendors billing again after a long silence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions.dates import whole_months_between
from ledgerlark.functions.text import sentence
from ledgerlark.operators.invoices import latest_invoice_dates, vendor_days
from ledgerlark.schema import DATE_LIKE, ID_LIKE, InvoiceColumns, require_rules, require_types


def dormant_vendors(
    invoices: DataFrame,
    *,
    window: int = 90,
    rules: str = "code",
    columns: InvoiceColumns = InvoiceColumns(),
) -> DataFrame:
    """Invoices arriving more than ``window`` calendar days after the vendor's previous one.

    Only the first invoice of a day can follow a gap, and only the last moment of the previous
    active day matters, so the window runs over active days: its rows per vendor are bounded by
    the calendar, whatever the number of invoices. Same-day ties go to the lowest
    (date, invoice id). Vendors seen for the first time never alert.
    """
    require_rules(rules)
    if window < 0:
        raise ValueError("window must not be negative")
    require_types(
        invoices,
        {columns.vendor: ID_LIKE, columns.invoice: ID_LIKE, columns.date: DATE_LIKE},
        "dormant_vendors",
    )
    return dormant_from_days(vendor_days(latest_invoice_dates(invoices, columns)), window=window, rules=rules)


def dormant_from_days(days: DataFrame, *, window: int = 90, rules: str = "code") -> DataFrame:
    """The alerts of ``vendor_days`` rows."""
    by_vendor = Window.partitionBy("vendor").orderBy("day")
    gaps = days.withColumn("previous", F.lag("closing").over(by_vendor)).where(
        F.datediff("day", "previous") > window
    )
    return gaps.select(
        F.col("vendor").alias("canonical_vendor_id"),
        F.col("opening.invoice").alias("invoice_id"),
        F.col("day").alias("insight_date"),
        sentence(
            "dormant",
            rules,
            vendor=F.col("vendor"),
            months=whole_months_between(F.col("opening.issued"), F.col("previous")),
        ).alias("insight_text"),
    )
