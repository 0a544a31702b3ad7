"""Compares each detector's plan with the direct shape of the same rule.

Prints one line per shape: seconds (best of 3), shuffle bytes written, jobs run. The direct
shapes give the same rows; they are here to be measured, not to be used.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) as for bench.py.
"""

from __future__ import annotations

import os
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bench import session
from ledgerlark.operators import accrual, cadence, dormant, spend
from ledgerlark.operators.invoices import latest_invoice_dates
from ledgerlark.schema import InvoiceColumns
from tests.helpers import misses_on_grid
from workload.mappings import banded_invoices, dense_invoices, line_items, sparse_invoices

NAMES = InvoiceColumns()


def lag_over_invoices(spark, sf_dir):
    by_vendor = Window.partitionBy("vendor").orderBy("issued", "invoice")
    latest = latest_invoice_dates(sparse_invoices(spark, sf_dir), NAMES)
    return latest.withColumn("previous", F.lag("issued").over(by_vendor)).where(
        F.datediff("issued", "previous") > 90
    )


def join_before_grouping(spark, sf_dir):
    ends = line_items(spark, sf_dir).select("invoice_id", F.col("period_end_date").alias("end"))
    joined = sparse_invoices(spark, sf_dir).join(ends, "invoice_id", "left")
    grouped = joined.groupBy("canonical_vendor_id", "invoice_id", "invoice_date")
    return grouped.agg(F.max("end").alias("end")).where(
        F.col("end") > F.date_add("invoice_date", 90)
    )


def branch_per_band(spark, sf_dir):
    history = spend.spend_history(banded_invoices(spark, sf_dir))
    branches = [history.where(spend.fires(band)) for band in spend.BANDS["code"]]
    filled = [branch for branch in branches if branch.count() > 0]
    return reduce(DataFrame.unionByName, filled)


def on_the_grid(invoices):
    def build(spark, sf_dir):
        table = invoices(spark, sf_dir)
        monthly, quarterly = misses_on_grid(table, "month", 3), misses_on_grid(
            table, "quarter", 2
        )
        return cadence.daily(monthly.unionByName(cadence.without_monthly(quarterly, monthly)))

    return build


SHAPES = {
    "dormant: window over active days": lambda s, d: dormant.dormant_vendors(
        sparse_invoices(s, d)
    ),
    "dormant: window over all invoices": lag_over_invoices,
    "accrual: group, then join": lambda s, d: accrual.accrual_alerts(
        sparse_invoices(s, d), line_items(s, d)
    ),
    "accrual: join, then group": join_before_grouping,
    "spend: one filter": lambda s, d: spend.large_months(banded_invoices(s, d)),
    "spend: counted branch per band": branch_per_band,
    "cadence, sparse vendors: runs of active cells": lambda s, d: cadence.missing_invoices(
        sparse_invoices(s, d)
    ),
    "cadence, sparse vendors: full grid": on_the_grid(sparse_invoices),
    "cadence, dense vendors: runs of active cells": lambda s, d: cadence.missing_invoices(
        dense_invoices(s, d)
    ),
    "cadence, dense vendors: full grid": on_the_grid(dense_invoices),
}


def shuffled_bytes(spark: SparkSession, df: DataFrame) -> int:
    """Bytes written by all exchanges of the executed plan."""

    def walk(node) -> int:
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ReusedExchangeExec":
            return 0
        own = 0
        if name == "ShuffleExchangeExec":
            own = node.metrics().apply("shuffleBytesWritten").value()
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.length()))

    return walk(df._jdf.queryExecution().executedPlan())


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    print(f"{'shape':50} {'sec':>7} {'shuffle':>12} {'jobs':>5} {'rows':>8}")
    for name, build in SHAPES.items():
        times = []
        for attempt in range(3):
            group = f"{name}#{attempt}"
            spark.sparkContext.setJobGroup(group, name)
            began = time.perf_counter()
            df = build(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
            jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        spark.sparkContext.setJobGroup("rows", name)
        rows = len(df.collect())
        written = shuffled_bytes(spark, df)
        print(f"{name:50} {min(times):7.2f} {written:12,} {jobs:5} {rows:8}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
