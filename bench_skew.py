"""Task balance of the detectors on an enlarged, lopsided version of the given tables.

A third of all invoices belongs to one vendor (a quarter of them on one day), a twelfth are
copies of a single invoice, another twelfth share one invoice id, and a third of all line items
belong to that id. Broadcasts are off and the skew thresholds low, so that local data takes the
path large data takes. For each detector the busiest stages are printed: if a hot key reached one
task, its time and records would stand far above the median.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_COPIES (default 20,
the factor by which the tables are enlarged).
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections import defaultdict
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import ledgerlark as ll
from ledgerlark.operators.invoices import (
    invoice_lines,
    latest_invoice_dates,
    with_previous_invoice,
)
from ledgerlark.schema import InvoiceColumns
from workload.mappings import line_items, sparse_invoices

SETTINGS = {
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16m",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "16g",
    "spark.eventLog.enabled": "true",
    "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false",
}


def lopsided_invoices(spark: SparkSession, sf_dir: str, copies: int) -> DataFrame:
    rows = sparse_invoices(spark, sf_dir).repartition(16)
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    part = F.pmod(F.xxhash64("invoice_id", "copy"), F.lit(12))
    seconds = F.pmod(F.xxhash64("copy", "invoice_id"), F.lit(86_399))
    moment = F.timestamp_seconds(F.unix_timestamp("invoice_date") + seconds)
    same_day = F.lit("1999-01-01").cast("timestamp")
    return rows.select(
        F.when(part == 11, "copied")
        .when(part == 10, "hot")
        .otherwise(F.concat_ws("-", "invoice_id", "copy"))
        .alias("invoice_id"),
        F.when(part < 4, "hot")
        .when(part == 11, "copied")
        .otherwise(F.concat_ws("-", "canonical_vendor_id", "copy"))
        .alias("canonical_vendor_id"),
        F.when((part == 0) | (part == 11), same_day).otherwise(moment).alias("invoice_date"),
        "period_end_date",
        "total_amount",
    )


def lopsided_lines(spark: SparkSession, sf_dir: str, copies: int) -> DataFrame:
    rows = line_items(spark, sf_dir).repartition(16)
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies // 2))))
    part = F.pmod(F.xxhash64("line_item_id", "copy"), F.lit(3))
    return rows.select(
        F.when(part == 0, "hot")
        .otherwise(F.concat_ws("-", "invoice_id", "copy"))
        .alias("invoice_id"),
        "line_item_id",
        "period_end_date",
    )


def busiest_stages(log_dir: str) -> dict[str, list[tuple]]:
    """Per job group: (total ms, tasks, median ms, max ms, median records, max records)."""
    group_of, tasks = {}, defaultdict(list)
    for path in Path(log_dir).iterdir():
        for line in path.open():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                group = (event.get("Properties") or {}).get("spark.jobGroup.id")
                for stage in event["Stage IDs"]:
                    group_of.setdefault(stage, group)
            elif event["Event"] == "SparkListenerTaskEnd":
                metrics = event["Task Metrics"]
                tasks[event["Stage ID"]].append(
                    (
                        metrics["Executor Run Time"],
                        metrics["Shuffle Read Metrics"]["Total Records Read"],
                    )
                )
    found = defaultdict(list)
    for stage, measured in tasks.items():
        times, records = zip(*measured, strict=True)
        found[group_of.get(stage)].append(
            (
                sum(times),
                len(times),
                round(statistics.median(times)),
                max(times),
                round(statistics.median(records)),
                max(records),
            )
        )
    return {group: sorted(stages, reverse=True)[:3] for group, stages in found.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    copies = int(os.environ.get("BENCH_COPIES", "20"))
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    log_dir = f"{folder}/events"
    os.mkdir(log_dir)
    builder = SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
    for key, value in {**SETTINGS, "spark.eventLog.dir": f"file://{log_dir}"}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    lopsided_invoices(spark, sf_dir, copies).write.parquet(f"{folder}/invoices")
    lopsided_lines(spark, sf_dir, copies).write.parquet(f"{folder}/lines")
    invoices = spark.read.parquet(f"{folder}/invoices")
    lines = spark.read.parquet(f"{folder}/lines")
    runs = {
        "dormant_vendors": lambda: ll.dormant_vendors(invoices),
        "accrual_alerts": lambda: ll.accrual_alerts(invoices, lines),
        "large_months": lambda: ll.large_months(invoices),
        "missing_invoices": lambda: ll.missing_invoices(invoices),
        "missing_invoices, documented": lambda: ll.missing_invoices(invoices, rules="documented"),
        "with_previous_invoice": lambda: with_previous_invoice(
            latest_invoice_dates(invoices, InvoiceColumns())
        ),
        # one invoice with the hot id, so that its line items match once
        "invoice_lines": lambda: invoice_lines(invoices.dropDuplicates(["invoice_id"]), lines),
    }
    print(f"{invoices.count():,} invoices, {lines.count():,} line items")
    seconds = {}
    for name, build in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        began = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        seconds[name] = time.perf_counter() - began
    spark.stop()

    stages = busiest_stages(log_dir)
    for name in runs:
        print(f"{name}: {seconds[name]:.1f} s")
        for _, tasks, median_ms, max_ms, median_records, max_records in stages[name]:
            print(
                f"  {tasks:4} tasks, median {median_ms:6} ms, max {max_ms:6} ms, "
                f"records median {median_records:9,}, max {max_records:9,}"
            )


if __name__ == "__main__":
    main()
