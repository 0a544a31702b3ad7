"""Calendars derived from the data: bounds, month starts, quarter starts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.dates import MONTHS_PER, cadence_start
from ledgerlark.schema import InvoiceColumns


def calendar_bounds(
    invoices: DataFrame, unit: str, columns: InvoiceColumns = InvoiceColumns()
) -> DataFrame:
    """One row: first and last cadence of the whole table. Nothing is collected."""
    return invoices.agg(
        cadence_start(F.min(columns.date), unit).alias("first_cadence"),
        cadence_start(F.max(columns.date), unit).alias("last_cadence"),
    )


def cadence_range(first: Column, last: Column, unit: str) -> Column:
    """Array of cadence starts from ``first`` to ``last``; NULL if either bound is NULL."""
    return F.sequence(first, last, F.expr(f"interval {MONTHS_PER[unit]} months"))


def calendar(
    invoices: DataFrame, unit: str, columns: InvoiceColumns = InvoiceColumns()
) -> DataFrame:
    """Every month or quarter start between the table's bounds."""
    return calendar_bounds(invoices, unit, columns).select(
        F.explode(cadence_range(F.col("first_cadence"), F.col("last_cadence"), unit)).alias(
            "cadence"
        )
    )
