"""Invoices whose line items cover periods far past the invoice date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.text import sentence
from ledgerlark.operators.invoices import INVOICE_KEY, keyed_by_invoice, last_service_days
from ledgerlark.schema import DATE_LIKE, ID_LIKE, InvoiceColumns, require_rules, require_types


def accrual_alerts(
    invoices: DataFrame,
    line_items: DataFrame,
    *,
    window: int = 90,
    rules: str = "code",
    columns: InvoiceColumns = InvoiceColumns(),
) -> DataFrame:
    """Invoices whose last period end is later than invoice date + ``window`` days.

    Line items are reduced to one row per invoice id before the join, and the date test runs
    inside the join, so only alerts reach the final grouping by (vendor, invoice, date).
    ``rules="documented"`` also counts the invoice's own period end.
    """
    require_rules(rules)
    documented = rules == "documented"
    contract = {columns.vendor: ID_LIKE, columns.invoice: ID_LIKE, columns.date: DATE_LIKE}
    if documented:
        contract[columns.period_end] = DATE_LIKE
    require_types(invoices, contract, "accrual_alerts (invoices)")
    require_types(
        line_items,
        {columns.invoice: ID_LIKE, columns.period_end: DATE_LIKE},
        "accrual_alerts (line items)",
    )
    own_end = [F.col(columns.period_end).alias("own_end")] if documented else []
    issued = keyed_by_invoice(
        invoices.select(
            F.col(columns.vendor).alias("vendor"),
            F.col(columns.invoice).alias("invoice"),
            F.col(columns.date).alias("issued"),
            *own_end,
        )
    )
    ends = keyed_by_invoice(last_service_days(line_items, columns))
    if documented:
        covered = issued.join(ends, INVOICE_KEY, "left").withColumn(
            "period_end", F.greatest("period_end", "own_end")
        )
    else:
        covered = issued.join(ends, INVOICE_KEY)
    late = (
        covered.where(F.col("period_end") > F.date_add("issued", window))
        .groupBy("vendor", "invoice", "issued")
        .agg(F.max("period_end").alias("period_end"))
    )
    return accrual_of(late, rules)


def accrual_of(late: DataFrame, rules: str = "code") -> DataFrame:
    """The alerts of (vendor, invoice, issued, period_end) rows past their window."""
    return late.select(
        F.col("vendor").alias("canonical_vendor_id"),
        F.col("invoice").alias("invoice_id"),
        F.to_date("issued").alias("insight_date"),
        F.col("issued").alias("insight_key"),
        sentence(
            "accrual",
            rules,
            vendor=F.col("vendor"),
            end=F.date_format("period_end", "yyyy-MM-dd"),
        ).alias("insight_text"),
    )
