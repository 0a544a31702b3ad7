"""Months whose spend lies far above the vendor's recent average."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions.money import (
    average_amount,
    UNITS,
    exceeds_average_by,
    from_units,
    percent_change,
    units,
)
from ledgerlark.functions.text import sentence
from ledgerlark.operators.invoices import invoice_amounts
from ledgerlark.schema import (
    DATE_LIKE,
    ID_LIKE,
    NUMERIC,
    InvoiceColumns,
    require_rules,
    require_types,
)


@dataclass(frozen=True)
class SpendBand:
    """Spend between ``low`` and ``high`` alerts when it exceeds the average by ``percent`` %."""

    low: int
    high: int | None
    percent: int
    low_included: bool = False
    high_included: bool = False

    def holds(self, spend: Column) -> Column:
        """Whether a spend in units lies in the band."""
        low = F.lit(self.low * UNITS)
        above = spend >= low if self.low_included else spend > low
        if self.high is None:
            return above
        high = F.lit(self.high * UNITS)
        return above & (spend <= high if self.high_included else spend < high)


# The spend bands as computed, and as described.
BANDS = {
    "code": (
        SpendBand(10000, None, 50),
        SpendBand(1000, 10000, 200),
        SpendBand(100, 1000, 500),
    ),
    "documented": (
        SpendBand(10000, None, 50),
        SpendBand(1000, 10000, 200, low_included=True, high_included=True),
        SpendBand(100, 1000, 500, low_included=True),
    ),
}


def monthly_spend(
    invoices: DataFrame, columns: InvoiceColumns = InvoiceColumns()
) -> DataFrame:
    """Spend per (vendor, month), each (vendor, invoice, date) counted once."""
    return (
        invoice_amounts(invoices.where(F.col(columns.date).isNotNull()), columns)
        .groupBy("vendor", F.trunc("issued", "month").alias("month"))
        .agg(F.sum("amount").alias("spend"))
    )


def trailing_days(window_days: int):
    """Frame: the current month and all months starting at most ``window_days`` earlier."""
    return (
        Window.partitionBy("vendor").orderBy(F.unix_date("month")).rangeBetween(-window_days, 0)
    )


def trailing_months(lookback_months: int, include_current: bool):
    """Frame: a number of calendar months up to, or just before, the current one."""
    month_number = F.year("month") * 12 + F.month("month")
    end = 0 if include_current else -1
    return (
        Window.partitionBy("vendor")
        .orderBy(month_number)
        .rangeBetween(end - lookback_months + 1, end)
    )


def spend_history(
    invoices: DataFrame,
    *,
    window_days: int = 365,
    lookback_months: int | None = None,
    include_current: bool = False,
    columns: InvoiceColumns = InvoiceColumns(),
) -> DataFrame:
    """Monthly spend with the total and number of the vendor's active months in the frame.

    The frame covers ``window_days`` before the month, or ``lookback_months`` calendar months
    when that is given. The window holds one row per vendor and month. ``spend`` and ``total``
    are in units.
    """
    return history_of_months(
        monthly_spend(invoices, columns),
        window_days=window_days,
        lookback_months=lookback_months,
        include_current=include_current,
    )


def history_of_months(
    monthly: DataFrame, *, window_days: int = 365, lookback_months: int | None = None, include_current: bool = False
) -> DataFrame:
    """``spend_history`` of rows as ``monthly_spend`` gives them."""
    frame = (
        trailing_days(window_days)
        if lookback_months is None
        else trailing_months(lookback_months, include_current)
    )
    return (
        monthly.withColumn("spend", units(F.col("spend")))
        .withColumns({"total": F.sum("spend").over(frame), "months": F.count("spend").over(frame)})
    )


def fires(band: SpendBand) -> Column:
    return (
        band.holds(F.col("spend"))
        & (F.col("spend") > 0)
        & (F.col("total") > 0)
        & exceeds_average_by(F.col("spend"), F.col("total"), F.col("months"), band.percent)
    )


def large_months(
    invoices: DataFrame,
    *,
    window_days: int = 365,
    lookback_months: int = 12,
    include_current: bool = False,
    bands: tuple[SpendBand, ...] | None = None,
    rules: str = "code",
    columns: InvoiceColumns = InvoiceColumns(),
) -> DataFrame:
    """Vendor-months whose spend exceeds the trailing average by their band's percentage.

    The bands are disjoint, so one OR filter over a single aggregation replaces a union of one
    branch per band. ``rules="documented"`` compares with ``lookback_months`` calendar months
    and prints the percentage instead of the average.
    """
    require_rules(rules)
    require_types(
        invoices,
        {
            columns.vendor: ID_LIKE,
            columns.invoice: ID_LIKE,
            columns.date: DATE_LIKE,
            columns.amount: NUMERIC,
        },
        "large_months",
    )
    documented = rules == "documented"
    history = spend_history(
        invoices,
        window_days=window_days,
        lookback_months=lookback_months if documented else None,
        include_current=include_current,
        columns=columns,
    )
    return large_from_history(history, bands=bands, rules=rules)


def large_from_history(
    history: DataFrame, *, bands: tuple[SpendBand, ...] | None = None, rules: str = "code"
) -> DataFrame:
    """The alerts of ``spend_history`` rows."""
    documented = rules == "documented"
    large = history.where(reduce(or_, [fires(band) for band in bands or BANDS[rules]]))
    spend, total, months = F.col("spend"), F.col("total"), F.col("months")
    versus = (
        percent_change(spend, total, months)
        if documented
        else average_amount(total, months)
    )
    return large.select(
        F.col("vendor").alias("canonical_vendor_id"),
        F.col("month").alias("insight_date"),
        sentence(
            "spend",
            rules,
            vendor=F.col("vendor"),
            spend=from_units(spend).cast("string"),
            versus=versus.cast("string"),
        ).alias("insight_text"),
    )
