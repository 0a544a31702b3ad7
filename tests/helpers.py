"""Small tables for the tests."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.dates import day_in_month
from ledgerlark.operators.grid import cell_measures

INVOICES = T.StructType(
    [
        T.StructField("canonical_vendor_id", T.StringType()),
        T.StructField("invoice_id", T.StringType()),
        T.StructField("invoice_date", T.TimestampType()),
        T.StructField("total_amount", T.DecimalType(18, 2)),
        T.StructField("period_end_date", T.TimestampType()),
    ]
)
LINES = T.StructType(
    [
        T.StructField("invoice_id", T.StringType()),
        T.StructField("line_item_id", T.StringType()),
        T.StructField("period_end_date", T.TimestampType()),
    ]
)


def moment(text):
    """'2020-01-31' or '2020-01-31 10:00' (in UTC, as is the test process)."""
    return None if text is None else datetime.fromisoformat(text)


def day(text):
    return date.fromisoformat(text)


def invoices(spark, *rows):
    """Rows are (vendor, invoice, date[, amount[, period end]])."""
    full = []
    for row in rows:
        vendor, invoice, issued, amount, end = (*row, None, None)[:5]
        money = None if amount is None else Decimal(str(amount))
        full.append((vendor, invoice, moment(issued), money, moment(end)))
    return spark.createDataFrame(full, INVOICES)


def lines(spark, *rows):
    """Rows are (invoice, period end)."""
    numbered = [(invoice, f"line-{n}", moment(end)) for n, (invoice, end) in enumerate(rows)]
    return spark.createDataFrame(numbered, LINES)


def found(df, *names):
    """The chosen columns of all rows, sorted, NULLs first."""
    rows = [tuple(row) for row in df.select(*names).collect()]
    return sorted(rows, key=lambda row: tuple((v is not None, str(v)) for v in row))


def misses_on_grid(table, unit, lookback):
    """Missed periods found cell by cell, on the grid of all vendors and all periods."""
    past = Window.partitionBy("vendor").orderBy("cadence").rowsBetween(-lookback, -1)
    cells = cell_measures(table, unit).select(
        "vendor",
        "cadence",
        F.coalesce("first_day", F.add_months("cadence", 1)).alias("end"),
        F.min("n_invoices").over(past).alias("fewest"),
        F.count(F.lit(1)).over(past).alias("seen"),
        day_in_month(F.col("cadence"), F.dayofmonth(F.min("first_day").over(past))).alias("start"),
    )
    return cells.where("fewest > 0 AND seen = {} AND `end` > start".format(lookback)).drop("fewest", "seen")
