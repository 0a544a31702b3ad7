"""Every registered query: the detectors, then the operators they are made of."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions import dates
from ledgerlark.functions.money import (
    average_amount,
    from_units,
    percent_change,
    units,
)
from ledgerlark.functions.text import TEMPLATES, render
from ledgerlark.operators import cadence, grid, spend
from ledgerlark.operators.accrual import accrual_alerts
from ledgerlark.operators.alerts import AlertLocation, AlertType, conform, with_names
from ledgerlark.operators.dormant import dormant_vendors
from ledgerlark.operators.invoices import (
    INVOICE_KEY,
    invoice_amounts,
    invoice_lines,
    keyed_by_invoice,
    last_service_days,
    latest_invoice_dates,
    with_previous_invoice,
)
from ledgerlark.plans.increments import SignalState
from ledgerlark.plans.run import run_config, run_signals
from ledgerlark.schema import InvoiceColumns, TableSpec
from ledgerlark.sources.calendar import calendar, calendar_bounds
from ledgerlark.sources.sinks import read_alerts, write_alerts
from ledgerlark.sources.scratch import new_path
from ledgerlark.sources.tables import column_kinds, read_typed, read_with_rejects
from workload.mappings import (
    banded_invoices,
    dense_invoices,
    line_items,
    sparse_invoices,
    untidy_invoices,
)

NAMES = InvoiceColumns()

SIGNAL_SETTINGS = {
    "VendorNotSeenInAWhile": {"invoice_data_loader": "invoice_data"},
    "AccrualAlert": {
        "invoice_data_loader": "invoice_data",
        "line_item_data_loader": "line_item_data",
    },
    "LargeMonthIncreaseMtd": {"invoice_data_loader": "invoice_data"},
    "NoInvoiceReceived": {"invoice_data_loader": "invoice_data"},
}

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Timestamps as dates and money as doubles, for comparison with another engine.

    For tables that hold midnights only; ``untidy_invoices`` does not.
    """
    casts = {"timestamp": "date", "timestamp_ntz": "date"}
    columns = []
    for field in df.schema:
        kind = field.dataType.simpleString()
        target = "double" if kind.startswith("decimal") else casts.get(kind)
        column = F.col(field.name)
        columns.append(column.cast(target).alias(field.name) if target else column)
    return df.select(*columns)


# --- detectors ---------------------------------------------------------------------------------


def sig_dormant_vendor(spark, sf_dir):
    return dormant_vendors(sparse_invoices(spark, sf_dir))


def sig_dormant_vendor_dense(spark, sf_dir):
    return dormant_vendors(dense_invoices(spark, sf_dir))


def sig_dormant_vendor_untidy(spark, sf_dir):
    return dormant_vendors(untidy_invoices(spark, sf_dir))


def sig_large_month_untidy(spark, sf_dir):
    return spend.large_months(untidy_invoices(spark, sf_dir))


def sig_no_invoice_untidy(spark, sf_dir):
    return cadence.missing_invoices(untidy_invoices(spark, sf_dir))


def sig_no_invoice_untidy_documented(spark, sf_dir):
    return cadence.missing_invoices(untidy_invoices(spark, sf_dir), rules="documented")


def sig_accrual(spark, sf_dir):
    alerts = accrual_alerts(sparse_invoices(spark, sf_dir), line_items(spark, sf_dir))
    return alerts.drop("insight_key")


def sig_accrual_documented(spark, sf_dir):
    alerts = accrual_alerts(
        sparse_invoices(spark, sf_dir), line_items(spark, sf_dir), rules="documented"
    )
    return alerts.drop("insight_key")


def sig_large_month(spark, sf_dir):
    return spend.large_months(banded_invoices(spark, sf_dir))


def sig_large_month_documented(spark, sf_dir):
    return spend.large_months(banded_invoices(spark, sf_dir), rules="documented")


def sig_cadence_monthly(spark, sf_dir):
    return cadence.monthly_misses(dense_invoices(spark, sf_dir)).drop("usual_day")


def sig_cadence_quarterly(spark, sf_dir):
    invoices = sparse_invoices(spark, sf_dir)
    return cadence.without_monthly(
        cadence.quarterly_misses(invoices), cadence.monthly_misses(invoices)
    ).drop("usual_day")


def sig_cadence_weekly(spark, sf_dir):
    return cadence.cadence_misses(dense_invoices(spark, sf_dir), "week").drop("usual_day")


def sig_cadence_half_year(spark, sf_dir):
    return cadence.cadence_misses(sparse_invoices(spark, sf_dir), "half_year").drop("usual_day")


def sig_cadence_fiscal_quarter(spark, sf_dir):
    """Quarters from February on, after four active ones."""
    fiscal = dates.Cadence("month", 3, lookback=4, starts=2)
    return cadence.cadence_misses(dense_invoices(spark, sf_dir), fiscal).drop("usual_day")


def sig_no_invoice_weekly(spark, sf_dir):
    return cadence.missing_invoices(dense_invoices(spark, sf_dir), cadences=["week"])


def sig_daily_expand(spark, sf_dir):
    return cadence.daily(cadence.monthly_misses(dense_invoices(spark, sf_dir)))


def sig_no_invoice(spark, sf_dir):
    return cadence.missing_invoices(sparse_invoices(spark, sf_dir))


def sig_no_invoice_dense(spark, sf_dir):
    return cadence.missing_invoices(dense_invoices(spark, sf_dir))


def sig_no_invoice_documented(spark, sf_dir):
    return cadence.missing_invoices(dense_invoices(spark, sf_dir), rules="documented")


def sig_no_invoice_sparse_documented(spark, sf_dir):
    return cadence.missing_invoices(sparse_invoices(spark, sf_dir), rules="documented")


def sig_normalize(spark, sf_dir):
    return conform(
        dormant_vendors(sparse_invoices(spark, sf_dir)),
        AlertType.VendorNotSeenInAWhile,
        AlertLocation.Invoice,
    )


def sig_normalize_documented(spark, sf_dir):
    alerts = conform(
        dormant_vendors(sparse_invoices(spark, sf_dir), rules="documented"),
        AlertType.VendorNotSeenInAWhile,
        AlertLocation.Invoice,
    )
    return with_names(alerts)


def _all(spark, sf_dir, rules):
    tables = {
        "invoice_data": sparse_invoices(spark, sf_dir),
        "line_item_data": line_items(spark, sf_dir),
    }
    return run_signals(tables, SIGNAL_SETTINGS, rules=rules)


def sig_all(spark, sf_dir):
    return _all(spark, sf_dir, "code")


def sig_all_documented(spark, sf_dir):
    return with_names(_all(spark, sf_dir, "documented"))


def sig_from_config(spark, sf_dir):
    invoices, lines = new_path(spark, "invoice"), new_path(spark, "line_item")
    dense_invoices(spark, sf_dir).write.option("header", True).csv(invoices)
    line_items(spark, sf_dir).write.option("header", True).csv(lines)
    config = {
        "Data": {
            "invoice_data": {
                "file_path": invoices,
                "string_columns": ["invoice_id", "canonical_vendor_id"],
                "datetime_columns": ["invoice_date", "period_end_date"],
                "float_columns": ["total_amount"],
            },
            "line_item_data": {
                "file_path": lines,
                "string_columns": ["invoice_id", "line_item_id"],
                "datetime_columns": ["period_end_date"],
            },
        },
        "Gleans": SIGNAL_SETTINGS,
        "OutputPath": new_path(spark, "gleans.csv"),
    }
    return run_config(spark, config, staged=True, shared=True)


# --- increments --------------------------------------------------------------------------------


def _in_batches(spark, invoices, lines=None):
    """The state after three batches; an invoice's rows, and its lines, may come in different ones."""
    state = SignalState(spark, new_path(spark, "signal-state"), buckets=8)
    for batch in range(3):
        part = invoices.where(F.pmod(F.xxhash64("invoice_id", "invoice_date"), F.lit(3)) == batch)
        state.apply(part, lines and lines.where(F.pmod(F.xxhash64("line_item_id"), F.lit(3)) == batch))
    return state


def sig_all_incremental(spark, sf_dir):
    return _in_batches(spark, sparse_invoices(spark, sf_dir), line_items(spark, sf_dir)).alerts()


def sig_untidy_incremental(spark, sf_dir):
    return _in_batches(spark, untidy_invoices(spark, sf_dir)).alerts()


# --- sources and sinks -------------------------------------------------------------------------


def load_typed_csv(spark, sf_dir):
    path = new_path(spark, "typed")
    sparse_invoices(spark, sf_dir).write.option("header", True).csv(path)
    spec = TableSpec(
        string_columns=("invoice_id", "canonical_vendor_id"),
        float_columns=("total_amount",),
        datetime_columns=("invoice_date",),
    )
    return plain(read_typed(spark, path, spec))


def _untidy_csv(spark, sf_dir):
    """Orders as a CSV table of texts, some of them not what they should be."""
    path, key = new_path(spark, "untidy"), F.col("o_orderkey")
    spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.lpad(key.cast("string"), 10, "0").alias("invoice_id"),
        F.col("o_custkey").cast("string").alias("customer"),
        F.when(key % 17 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("invoice_date"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.when(key % 13 == 0, "n/a").otherwise((key % 1000).cast("string")).alias("total_amount"),
        F.format_string("%d.%02d", (key % 977).cast("int"), (key % 100).cast("int")).alias("price"),
    ).write.option("header", True).csv(path)
    return path


def load_typed_csv_rejects(spark, sf_dir):
    spec = TableSpec(
        string_columns=("invoice_id",), float_columns=("total_amount",), datetime_columns=("invoice_date",)
    )
    _, rejects = read_with_rejects(spark, _untidy_csv(spark, sf_dir), spec)
    return rejects.drop("file")


def load_inferred_csv(spark, sf_dir):
    texts = spark.read.option("header", True).csv(_untidy_csv(spark, sf_dir))
    return column_kinds(texts)


def sig_all_shared(spark, sf_dir):
    tables = {
        "invoice_data": sparse_invoices(spark, sf_dir),
        "line_item_data": line_items(spark, sf_dir),
    }
    return run_signals(tables, SIGNAL_SETTINGS, shared=True)


def sink_csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "alerts")
    write_alerts(sig_normalize(spark, sf_dir), path)
    return read_alerts(spark, path)


def cal_bounds(spark, sf_dir):
    return calendar_bounds(sparse_invoices(spark, sf_dir), "month")


def cal_months(spark, sf_dir):
    return calendar(sparse_invoices(spark, sf_dir), "month")


def cal_quarters(spark, sf_dir):
    return calendar(sparse_invoices(spark, sf_dir), "quarter")


# --- joins -------------------------------------------------------------------------------------


def join_left_invoice_lines(spark, sf_dir):
    return plain(invoice_lines(sparse_invoices(spark, sf_dir), line_items(spark, sf_dir)))


def join_cross_calendar(spark, sf_dir):
    return grid.vendor_calendar(sparse_invoices(spark, sf_dir), "month")


def join_left_grid(spark, sf_dir):
    return grid.grid_with_invoices(sparse_invoices(spark, sf_dir), "month")


def join_anti_quarter(spark, sf_dir):
    invoices = dense_invoices(spark, sf_dir)
    kept = cadence.without_monthly(
        cadence.quarterly_misses(invoices), cadence.monthly_misses(invoices)
    )
    return kept.select("vendor", "cadence")


# --- aggregations ------------------------------------------------------------------------------


def agg_invoice_latest_date(spark, sf_dir):
    return plain(latest_invoice_dates(banded_invoices(spark, sf_dir), NAMES))


def agg_invoice_period_end(spark, sf_dir):
    invoices = keyed_by_invoice(
        sparse_invoices(spark, sf_dir).select(
            F.col("canonical_vendor_id").alias("vendor"),
            F.col("invoice_id").alias("invoice"),
            F.col("invoice_date").alias("issued"),
        )
    )
    ends = keyed_by_invoice(last_service_days(line_items(spark, sf_dir), NAMES))
    joined = invoices.join(ends, INVOICE_KEY, "left")
    return plain(
        joined.groupBy("vendor", "invoice", "issued").agg(
            F.max("period_end").alias("period_end")
        )
    )


def agg_invoice_amount(spark, sf_dir):
    return plain(invoice_amounts(banded_invoices(spark, sf_dir), NAMES))


def agg_monthly_spend(spark, sf_dir):
    return plain(spend.monthly_spend(banded_invoices(spark, sf_dir)))


def agg_cadence_first_and_n(spark, sf_dir):
    return grid.cell_measures(dense_invoices(spark, sf_dir), "quarter")


def distinct_vendors(spark, sf_dir):
    return grid.distinct_vendors(sparse_invoices(spark, sf_dir))


# --- windows -----------------------------------------------------------------------------------


def win_lag_invoice_date(spark, sf_dir):
    latest = latest_invoice_dates(sparse_invoices(spark, sf_dir), NAMES)
    return plain(with_previous_invoice(latest))


def filter_has_previous(spark, sf_dir):
    latest = latest_invoice_dates(dense_invoices(spark, sf_dir), NAMES)
    return plain(with_previous_invoice(latest).where(F.col("previous").isNotNull()))


def win_lag_invoice_date_untidy(spark, sf_dir):
    """With times of day, as texts to the second."""
    latest = latest_invoice_dates(untidy_invoices(spark, sf_dir), NAMES)
    moments = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("issued", "previous")]
    return with_previous_invoice(latest).select("vendor", "invoice", *moments)


def filter_has_previous_untidy(spark, sf_dir):
    """With times of day, as texts to the second."""
    lagged = win_lag_invoice_date_untidy(spark, sf_dir)
    return lagged.where(F.col("previous").isNotNull())


def _history(spark, sf_dir):
    return spend.spend_history(banded_invoices(spark, sf_dir))


def _averages(history):
    return plain(
        history.select(
            "vendor",
            "month",
            from_units(F.col("spend")).alias("spend"),
            "months",
            average_amount(F.col("total"), F.col("months")).alias("average_spend"),
        )
    )


def _percents(history):
    """Percent above or below the trailing average, rounded; zero unless both are positive."""
    positive = (F.col("spend") > 0) & (F.col("total") > 0)
    percent = percent_change(F.col("spend"), F.col("total"), F.col("months"))
    return plain(
        history.select(
            "vendor",
            "month",
            F.when(positive, percent).otherwise(0).alias("percent_above"),
        )
    )


def win_range_avg_spend(spark, sf_dir):
    return _averages(_history(spark, sf_dir))


def win_range_avg_spend_untidy(spark, sf_dir):
    return _averages(spend.spend_history(untidy_invoices(spark, sf_dir)))


def spend_pct_change(spark, sf_dir):
    return _percents(_history(spark, sf_dir))


def spend_pct_change_untidy(spark, sf_dir):
    return _percents(spend.spend_history(untidy_invoices(spark, sf_dir)))


def spend_bands(spark, sf_dir):
    """Alerts per band, counted in one pass."""
    fired = [
        F.when(spend.fires(band), number)
        for number, band in enumerate(spend.BANDS["code"], start=1)
    ]
    return (
        _history(spark, sf_dir)
        .select(F.coalesce(*fired).alias("band"))
        .where(F.col("band").isNotNull())
        .groupBy("band")
        .agg(F.count("*").alias("n"))
    )


def union_spend_bands(spark, sf_dir):
    """The bands as one branch each, united by name: the shape the single OR filter replaces."""
    history = _history(spark, sf_dir)
    branches = [
        history.where(spend.fires(band)).select(
            "vendor", "month", from_units(F.col("spend")).alias("spend"), F.lit(n).alias("band")
        )
        for n, band in enumerate(spend.BANDS["code"], start=1)
    ]
    return plain(reduce(lambda left, right: left.unionByName(right), branches))


def _cells_with_history(spark, sf_dir):
    return grid.with_history(grid.cell_measures(dense_invoices(spark, sf_dir), "month"), 3)


def win_rows_min_first(spark, sf_dir):
    return _cells_with_history(spark, sf_dir).select("vendor", "cadence", "earliest_day")


def win_rows_collect_set(spark, sf_dir):
    days = F.array_join(F.col("first_days").cast("array<string>"), ",")
    return _cells_with_history(spark, sf_dir).select(
        "vendor", "cadence", days.alias("first_days")
    )


def win_multi_lag(spark, sf_dir):
    lags = [f"back_{n}" for n in (1, 2, 3)]
    cells = _cells_with_history(spark, sf_dir)
    return cells.select("vendor", "cadence", "n_invoices", *lags)


# --- set operations and scalar functions -------------------------------------------------------


def union_missing_columns(spark, sf_dir):
    """Invoice-level and vendor-level insights in one table, the absent invoice id as NULL."""
    invoices = sparse_invoices(spark, sf_dir)
    return (
        dormant_vendors(invoices)
        .unionByName(spend.large_months(invoices), allowMissingColumns=True)
        .unionByName(cadence.missing_invoices(invoices), allowMissingColumns=True)
    )


def fn_dates(spark, sf_dir):
    day, end = F.col("invoice_date"), F.col("period_end_date")
    month = dates.cadence_start(day, "month")
    next_month = dates.shift_cadence(month, "month", 1)
    return sparse_invoices(spark, sf_dir).select(
        "invoice_id",
        F.to_date(day).alias("as_date"),
        F.to_date(F.to_utc_timestamp(day, "UTC")).alias("as_utc"),
        month.alias("month_start"),
        dates.cadence_start(day, "quarter").alias("quarter_start"),
        F.year(day).alias("y"),
        F.month(day).alias("m"),
        F.dayofmonth(day).alias("d"),
        F.datediff(end, day).cast("long").alias("gap_days"),
        dates.whole_months_between(end, day).alias("gap_months"),
        F.date_add(day, 90).alias("plus_90"),
        F.date_format(day, "yyyy-MM-dd").alias("day_text"),
        F.unix_timestamp(month).alias("month_seconds"),
        dates.day_in_month(next_month, F.dayofmonth(day)).alias("same_day_next_month"),
        dates.day_in_month_clamped(next_month, F.dayofmonth(day)).alias("same_day_clamped"),
        F.try_to_date(
            F.concat_ws("-", F.year(next_month), F.month(next_month), F.lit(28))
        ).alias("parsed_day"),
    )


def fn_text(spark, sf_dir):
    vendor, day = F.col("canonical_vendor_id"), F.to_date("invoice_date")
    texts = TEMPLATES["code"]
    money = from_units(units(F.col("total_amount"))).cast("string")
    return sparse_invoices(spark, sf_dir).select(
        "invoice_id",
        render(texts["dormant"], vendor=vendor, months=F.lit(4)).alias("dormant"),
        render(
            texts["accrual"], vendor=vendor, end=F.date_format("period_end_date", "yyyy-MM-dd")
        ).alias("accrual"),
        render(texts["spend"], vendor=vendor, spend=money, versus=money).alias("spend"),
        render(
            texts["missing"],
            vendor=vendor,
            day=F.dayofmonth(day).cast("string"),
            unit=F.lit("month"),
            date=day.cast("string"),
        ).alias("missing"),
        render(
            texts["dormant"], vendor=F.nullif(vendor, F.lit("7")), months=F.lit(4)
        ).isNull().cast("int").alias("null_text"),
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        sig_all,
        sig_all_documented,
        sig_from_config,
        sig_dormant_vendor,
        sig_dormant_vendor_dense,
        sig_dormant_vendor_untidy,
        sig_large_month_untidy,
        sig_no_invoice_untidy,
        sig_no_invoice_untidy_documented,
        sig_accrual,
        sig_accrual_documented,
        sig_large_month,
        sig_large_month_documented,
        sig_no_invoice,
        sig_no_invoice_dense,
        sig_no_invoice_documented,
        sig_no_invoice_sparse_documented,
        sig_cadence_monthly,
        sig_cadence_quarterly,
        sig_cadence_weekly,
        sig_cadence_half_year,
        sig_cadence_fiscal_quarter,
        sig_no_invoice_weekly,
        sig_daily_expand,
        sig_normalize,
        sig_normalize_documented,
        sig_all_incremental,
        sig_untidy_incremental,
        sig_all_shared,
        load_typed_csv,
        load_typed_csv_rejects,
        load_inferred_csv,
        sink_csv_roundtrip,
        cal_bounds,
        cal_months,
        cal_quarters,
        join_left_invoice_lines,
        join_cross_calendar,
        join_left_grid,
        join_anti_quarter,
        agg_invoice_latest_date,
        agg_invoice_period_end,
        agg_invoice_amount,
        agg_monthly_spend,
        agg_cadence_first_and_n,
        distinct_vendors,
        win_lag_invoice_date,
        filter_has_previous,
        win_lag_invoice_date_untidy,
        filter_has_previous_untidy,
        win_range_avg_spend,
        win_range_avg_spend_untidy,
        spend_pct_change_untidy,
        win_rows_min_first,
        win_rows_collect_set,
        win_multi_lag,
        spend_pct_change,
        spend_bands,
        union_spend_bands,
        union_missing_columns,
        fn_dates,
        fn_text,
    )
}
