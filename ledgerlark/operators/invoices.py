"""Invoice-level building blocks shared by the detectors.

Every function here is written so that no task has to hold an unbounded group, even when one
vendor, one invoice id or one set of identical rows makes up a large part of the input:
aggregates combine map-side before their shuffle, and windows run only over rows whose number
per vendor the calendar bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions.money import exact_amount
from ledgerlark.schema import InvoiceColumns


def latest_invoice_dates(invoices: DataFrame, columns: InvoiceColumns) -> DataFrame:
    """One row per (vendor, invoice) with its latest date."""
    return invoices.groupBy(
        F.col(columns.vendor).alias("vendor"), F.col(columns.invoice).alias("invoice")
    ).agg(F.max(columns.date).alias("issued"))


def invoice_amounts(invoices: DataFrame, columns: InvoiceColumns) -> DataFrame:
    """One row per (vendor, invoice, date) with the largest amount among its copies.

    Amounts have six decimals; NaN and infinity count as absent, and what does not fit raises.
    """
    return invoices.groupBy(
        F.col(columns.vendor).alias("vendor"),
        F.col(columns.invoice).alias("invoice"),
        F.col(columns.date).alias("issued"),
    ).agg(F.max(exact_amount(F.col(columns.amount), invoices.schema[columns.amount].dataType)).alias("amount"))


def last_service_days(line_items: DataFrame, columns: InvoiceColumns) -> DataFrame:
    """One row per invoice id with the latest period end among its line items."""
    return line_items.groupBy(F.col(columns.invoice).alias("invoice")).agg(
        F.max(columns.period_end).alias("period_end")
    )


def keyed_by_invoice(df: DataFrame) -> DataFrame:
    """Add a join-key hash next to the invoice id.

    Joining on (invoice, invoice_hash) instead of invoice alone means neither an aggregate below
    the join nor one above it is co-partitioned with the join. Both join inputs therefore come
    straight from an exchange, which is what adaptive execution needs to split a hot invoice id
    over many tasks or to broadcast a side that proves small at run time.
    """
    return df.withColumn("invoice_hash", F.xxhash64("invoice"))


INVOICE_KEY = ["invoice", "invoice_hash"]


def vendor_days(latest: DataFrame) -> DataFrame:
    """One row per (vendor, day): the day's opening invoice and its last moment.

    The opening invoice's id is a text, so Spark aggregates here in sorted order, map-side over every
    invoice. The hash of vendor and day comes first in that order: rows are told apart by a number,
    where many invoices share few vendors too.
    """
    return (
        latest.where(F.col("issued").isNotNull())
        .withColumn("day", F.to_date("issued"))
        .withColumn("vendor_day", F.xxhash64("vendor", "day"))
        .groupBy("vendor_day", "vendor", "day")
        .agg(
            F.min(F.struct("issued", "invoice")).alias("opening"),
            F.max("issued").alias("closing"),
        )
        .drop("vendor_day")
    )


def present(id: Column) -> Column:
    """An id as a text that is never NULL, so that NULLs equal each other; it keeps the order, NULL first."""
    return F.coalesce(F.concat(F.lit("="), id), F.lit("-"))


def with_previous_invoice(latest: DataFrame) -> DataFrame:
    """Each invoice with the date of the vendor's previous one, ordered by (date, invoice id).

    A plain ``lag`` over the vendor would pull all invoices of a hot vendor into one task. Here only
    distinct moments need a predecessor, and a vendor's moments are looked at hour by hour. The first
    of an hour follows the last moment of the vendor's hour before: one row per vendor and active
    hour, bounded by the calendar, carries that over. Any further invoice at the same moment follows a
    twin, so its predecessor has its own date. One exchange each for the moments, the hours and the
    carried rows, and two for the join by invoice.
    """
    keyed = latest.select(
        present(F.col("vendor")).alias("v"), present(F.col("invoice")).alias("i"), "vendor", "invoice", "issued"
    )
    moments = (
        keyed.where(F.col("issued").isNotNull())
        .groupBy("v", "issued")
        .agg(F.min("i").alias("i"))
        .withColumn("hour", F.date_trunc("hour", "issued"))
    )
    in_hour = Window.partitionBy("v", "hour")
    seen = moments.withColumns(
        {"before": F.lag("issued").over(in_hour.orderBy("issued")), "last": F.max("issued").over(in_hour)}
    )
    first = seen.where(F.col("before").isNull()).withColumn(
        "before", F.lag("last").over(Window.partitionBy("v").orderBy("hour"))
    )
    further = seen.where(F.col("before").isNotNull())
    openers = first.unionByName(further).select("v", "i", "before", F.lit(True).alias("opens_moment"))
    return keyed.join(openers, ["v", "i"], "left").select(
        "vendor",
        "invoice",
        "issued",
        F.when(F.col("opens_moment"), F.col("before")).otherwise(F.col("issued")).alias("previous"),
    )


def invoice_lines(
    invoices: DataFrame, line_items: DataFrame, columns: InvoiceColumns = InvoiceColumns()
) -> DataFrame:
    """Invoices left-joined to their line items on the invoice id.

    Written as matches plus unmatched invoices: an inner join can be split on either side when
    one invoice id is hot, a left join cannot be split on its right side.
    """
    left = keyed_by_invoice(
        invoices.select(
            F.col(columns.invoice).alias("invoice"),
            F.col(columns.vendor).alias("vendor"),
            F.col(columns.date).alias("issued"),
        )
    )
    right = keyed_by_invoice(
        line_items.select(
            F.col(columns.invoice).alias("invoice"),
            F.col(columns.line_item).alias("line_item"),
            F.col(columns.period_end).alias("period_end"),
        )
    )
    names = ["invoice", "vendor", "issued", "line_item", "period_end"]
    matched = left.join(right, INVOICE_KEY).select(*names)
    known = right.select("invoice").distinct()
    unmatched = left.join(keyed_by_invoice(known), INVOICE_KEY, "left_anti")
    return matched.unionByName(
        unmatched.select("invoice", "vendor", "issued"), allowMissingColumns=True
    ).select(*names)
