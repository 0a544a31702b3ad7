"""What the plans look like: no Python workers, no jobs before the action, hot keys split."""

import re

import pytest
from pyspark.sql import functions as F

import ledgerlark as ll
from ledgerlark.operators.invoices import invoice_lines, latest_invoice_dates, vendor_days, with_previous_invoice
from workload.mappings import line_items, sparse_invoices, untidy_invoices
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
EAGER = {  # they write first
    "sig_from_config", "load_typed_csv", "sink_csv_roundtrip", "sig_all_incremental", "sig_untidy_incremental",
    "load_typed_csv_rejects", "load_inferred_csv", "sig_all_shared",
}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_plan(spark, name):
    spark.sparkContext.setJobGroup(f"build-{name}", "")
    df = QUERIES[name](spark, SF)
    plan = physical(df)
    reads = spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")
    # listing a parquet file's schema is the only thing done before the action
    assert len(reads) <= plan.count("FileScan")
    for unwanted in (
        "Python",
        "Pandas",
        "CartesianProduct",
        "NestedLoopJoin",
        "MapPartitions",
        "SinglePartition, REPARTITION",
    ):
        assert unwanted not in plan
    # a single-partition exchange may only carry one pre-aggregated row per task
    for match in re.finditer(r"Exchange SinglePartition.*\n.*", plan):
        assert "partial_" in match.group()


def test_reads_only_the_columns_in_use(spark):
    plan = physical(ll.missing_invoices(sparse_invoices(spark, SF)))
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert schemas
    assert all("o_totalprice" not in schema for schema in schemas)


@pytest.fixture
def split_eagerly(spark):
    """Make adaptive execution treat even small partitions as skewed, and never broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    saved = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in saved.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def hot(spark, df, column, value):
    """The table with a third of its rows moved to one id."""
    moved = F.when(F.pmod(F.xxhash64(*df.columns), F.lit(3)) == 0, value).otherwise(F.col(column))
    return df.withColumn(column, moved)


def test_hot_invoice_id_is_split_in_the_accrual_join(spark, split_eagerly):
    sf = "/root/testdata/sf0.01"
    table = hot(spark, sparse_invoices(spark, sf), "invoice_id", "7").repartition(8)
    for rules in ("code", "documented"):
        alerts = ll.accrual_alerts(table, line_items(spark, sf), rules=rules)
        rows = alerts.collect()
        assert "SortMergeJoin(skew=true)" in physical(alerts)
        plain = table.join(
            line_items(spark, sf).groupBy("invoice_id").agg(F.max("period_end_date").alias("end")),
            "invoice_id",
            "left",
        )
        if rules == "documented":
            plain = plain.withColumn("end", F.greatest("end", "period_end_date"))
        expected = plain.where(F.col("end") > F.date_add("invoice_date", 90)).select(
            "invoice_id", "canonical_vendor_id", "invoice_date"
        )
        assert len(rows) == expected.distinct().count() > 1000


def test_hot_invoice_id_is_split_in_the_line_join(spark, split_eagerly):
    sf = "/root/testdata/sf0.01"
    lines = hot(spark, line_items(spark, sf), "invoice_id", "7").repartition(8)
    joined = invoice_lines(sparse_invoices(spark, sf), lines)
    rows = joined.collect()
    assert "SortMergeJoin(skew=true)" in physical(joined)
    matched = sum(row.line_item is not None for row in rows)
    assert matched == lines.count()


def test_windows_hold_days_or_months_not_invoices(spark):
    """A vendor with all invoices on few days reaches the windows as those few days."""
    days = 40
    rows = spark.range(60_000).select(
        F.lit("hot").alias("canonical_vendor_id"),
        F.col("id").cast("string").alias("invoice_id"),
        F.timestamp_seconds(1_577_836_800 + (F.col("id") % days) * 86_400 * 100).alias(
            "invoice_date"
        ),
        F.lit(1).cast("decimal(18,2)").alias("total_amount"),
    )
    for df, limit in (
        (ll.dormant_vendors(rows), days),
        (ll.large_months(rows), days),
        (ll.missing_invoices(rows), days),
    ):
        df.collect()
        assert 0 < widest_window(df) <= limit


def widest_window(df):
    """Most rows any Window operator of the executed plan received."""
    widest = 0

    def walk(node):
        nonlocal widest
        name = node.getClass().getSimpleName()
        if name == "WindowExec":
            widest = max(widest, received(node.child()))
        for child in children(node):
            walk(child)

    def children(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return [node.executedPlan()]
        if name.endswith("QueryStageExec"):
            return [node.plan()]
        found = node.children()
        return [found.apply(i) for i in range(found.length())]

    def received(node):
        metric = node.metrics().get("numOutputRows")
        if metric.isDefined():
            return metric.get().value()
        return max((received(child) for child in children(node)), default=0)

    walk(df._jdf.queryExecution().executedPlan())
    return widest


def executed(df):
    """The final plan's lines, without those of initial plans and of what is reused."""
    df.collect()
    kept, skipped = [], None
    for line in physical(df).split("\n"):
        indent = re.search(r"[^ :+-]|$", line).start()
        if skipped is not None and indent >= skipped:
            continue
        skipped = indent if "== Initial Plan ==" in line else None
        if skipped is None:
            kept.append(line)
    return "\n".join(kept)


def test_days_are_sorted_by_a_number_first(spark):
    rows = [("a", "i2", "2020-01-01 10:00"), ("a", "i1", "2020-01-01 10:00"), ("a", None, "2020-01-02 09:00"),
            (None, "i3", "2020-01-01 11:00"), (None, "i4", "2020-01-01 12:00"), ("b", "i5", None)]
    latest = spark.createDataFrame(rows, "vendor string, invoice string, issued string").withColumn(
        "issued", F.col("issued").cast("timestamp")
    )
    days = vendor_days(latest)
    assert days.columns == ["vendor", "day", "opening", "closing"]
    found = [(r.vendor, str(r.day), r.opening.invoice, str(r.closing)) for r in days.collect()]
    assert sorted(found, key=str) == [
        ("a", "2020-01-01", "i1", "2020-01-01 10:00:00"),
        ("a", "2020-01-02", None, "2020-01-02 09:00:00"),
        (None, "2020-01-01", "i3", "2020-01-01 12:00:00"),
    ]
    sorts = re.findall(r"Sort \[(\w+)#", physical(vendor_days(latest)))
    assert sorts and set(sorts) == {"vendor_day"}


def test_newest_date_takes_no_scan_of_its_own(spark):
    for options in ({}, {"rules": "documented"}):
        plan = executed(ll.missing_invoices(sparse_invoices(spark, SF), **options))
        assert plan.count("FileScan") == 1
        assert "Subquery" in plan


def test_counters_take_no_object_aggregates(spark):
    plan = executed(ll.missing_invoices(sparse_invoices(spark, SF), rules="documented"))
    assert "ObjectHashAggregate" not in plan and "Generate explode(flatten" not in plan


def test_counters_are_neither_shuffled_nor_sorted(spark):
    alerts = ll.missing_invoices(sparse_invoices(spark, SF), rules="documented")
    plan = executed(alerts)
    assert len(re.findall(r"- Exchange hashpartitioning", plan)) <= 3
    alerts = ll.missing_invoices(sparse_invoices(spark, SF), rules="documented")
    with_inputs = alerts._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    moved = re.findall(r"\n\(\d+\) (?:Exchange|Sort)\b[^\n]*\nInput \[\d+\]: ([^\n]*)", with_inputs)
    assert len(moved) > 5 and not any("n_31#" in names for names in moved)


def test_previous_invoices_take_few_exchanges(spark):
    lagged = with_previous_invoice(latest_invoice_dates(sparse_invoices(spark, SF), ll.InvoiceColumns()))
    assert len(re.findall(r"(?<!Reused)Exchange hashpartitioning", executed(lagged))) <= 6


def test_hot_vendor_is_split_for_previous_invoices(spark, split_eagerly):
    """No task gets more of a vendor with a third of all invoices than an hour's distinct moments."""
    table = hot(spark, untidy_invoices(spark, "/root/testdata/sf0.01"), "canonical_vendor_id", "7")
    latest = latest_invoice_dates(table, ll.InvoiceColumns()).cache()
    lagged = with_previous_invoice(latest)
    rows = sorted(lagged.collect(), key=lambda r: tuple((x is not None, x) for x in (r["vendor"], r["issued"], r["invoice"])))
    assert len(rows) == latest.count() and sum(r["vendor"] == "7" for r in rows) > len(rows) / 4
    assert any(r["vendor"] is None for r in rows)
    before = {}
    for r in rows:
        assert r["previous"] == before.get(r["vendor"])
        before[r["vendor"]] = r["issued"]
    windows = re.findall(r"Window \[[^\n]*windowspecdefinition\((\w+)#\d+, (\w+)", physical(lagged))
    assert {(a, b) for a, b in windows} == {("v", "hour")}


def test_shared_invoices_are_read_once(spark):
    tables = {"inv": sparse_invoices(spark, SF), "lines": line_items(spark, SF)}
    settings = {
        "VendorNotSeenInAWhile": {"invoice_data_loader": "inv"},
        "AccrualAlert": {"invoice_data_loader": "inv", "line_item_data_loader": "lines"},
        "LargeMonthIncreaseMtd": {"invoice_data_loader": "inv"},
        "NoInvoiceReceived": {"invoice_data_loader": "inv"},
    }
    files = ll.run_signals(tables, settings, shared=True).inputFiles()
    assert not any("orders.parquet" in f for f in files) and any("staged-" in f for f in files)
