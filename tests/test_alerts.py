import re

import pytest
from pyspark.sql import functions as F

import ledgerlark as ll
from ledgerlark.operators.cadence import monthly_misses
from ledgerlark.plans import registry
from tests.helpers import found, invoices, lines


@pytest.fixture
def tables(spark):
    table = invoices(
        spark,
        ("v", "a", "2020-01-01", "10", "2020-01-31"),
        ("v", "b", "2020-06-01", "90000", "2020-06-30"),
        (None, "c", "2020-01-01", "10", None),
        (None, "d", "2020-08-01", "10", None),
        *[("m", f"m{n}", f"2020-0{n}-10", "10", None) for n in (1, 2, 3, 6)],
    )
    return {"inv": table, "li": lines(spark, ("a", "2020-12-31"), ("b", "2020-12-31"))}


INVOICES_ONLY = {"invoice_data_loader": "inv"}
ALL = {
    "VendorNotSeenInAWhile": INVOICES_ONLY,
    "AccrualAlert": {"invoice_data_loader": "inv", "line_item_data_loader": "li"},
    "LargeMonthIncreaseMtd": INVOICES_ONLY,
    "NoInvoiceReceived": INVOICES_ONLY,
}


def test_schema_codes_and_locations(tables):
    alerts = ll.run_signals(tables, ALL)
    assert [(f.name, f.dataType) for f in alerts.schema] == [
        (f.name, f.dataType) for f in ll.ALERT_SCHEMA
    ]
    kinds = alerts.groupBy("glean_type", "glean_location", F.isnull("invoice_id").alias("none"))
    assert found(kinds.count(), "glean_type", "glean_location", "none") == [
        (1, 1, False),
        (2, 1, False),
        (3, 2, True),
        (4, 2, True),
    ]


def test_rows_are_the_sum_of_the_parts(tables):
    parts = sum(ll.run_signals(tables, {name: ALL[name]}).count() for name in ALL)
    assert ll.run_signals(tables, ALL).count() == parts > 0


def test_ids_are_stable_distinct_and_uuid_shaped(tables, spark):
    first = [row.glean_id for row in ll.run_signals(tables, ALL).collect()]
    shuffled = {name: df.repartition(5, F.rand(3)) for name, df in tables.items()}
    again = [row.glean_id for row in ll.run_signals(shuffled, ALL).collect()]
    assert sorted(first) == sorted(again)
    assert len(set(first)) == len(first)
    shape = re.compile(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")
    assert all(shape.fullmatch(identifier) for identifier in first)
    random = [row.glean_id for row in ll.run_signals(tables, ALL, ids="random").collect()]
    assert len(set(random)) == len(first) and not set(random) & set(first)


def test_one_invoice_at_two_times_of_a_day_has_two_ids(spark):
    table = invoices(spark, ("v", "a", "2020-01-01 08:00"), ("v", "a", "2020-01-01 09:00"))
    alerts = ll.conform(ll.accrual_alerts(table, lines(spark, ("a", "2020-12-31"))), 2, 1)
    assert len({row.glean_id for row in alerts.collect()}) == 2


def test_any_subset_runs(tables, spark):
    vendor_only = ll.run_signals(tables, {"NoInvoiceReceived": INVOICES_ONLY})
    assert vendor_only.columns == ll.ALERT_SCHEMA.names and vendor_only.count() > 0
    nothing = ll.run_signals(tables, {})
    assert nothing.schema == ll.ALERT_SCHEMA and nothing.count() == 0


def test_settings_reach_the_detector(tables):
    # the gaps are 92 days (m), 152 days (v) and 213 days (no vendor)
    for window, alerts in ((90, 3), (100, 2), (160, 1)):
        settings = {"VendorNotSeenInAWhile": {**INVOICES_ONLY, "window": window}}
        assert ll.run_signals(tables, settings).count() == alerts


def test_documented_names(tables):
    alerts = ll.with_names(ll.run_signals(tables, ALL, rules="documented"))
    kinds = alerts.select("glean_type", "glean_location").distinct()
    assert found(kinds, "glean_type", "glean_location") == [
        ("accrual_alert", "invoice"),
        ("large_month_increase_mtd", "vendor"),
        ("no_invoice_received", "vendor"),
        ("vendor_not_seen_in_a_while", "invoice"),
    ]


def test_wrong_settings(tables):
    with pytest.raises(ValueError, match="unknown detectors: Nope"):
        ll.run_signals(tables, {"Nope": {}})
    with pytest.raises(ValueError, match="no table named 'other'"):
        ll.run_signals(tables, {"NoInvoiceReceived": {"invoice_data_loader": "other"}})
    with pytest.raises(ValueError, match="needs: line_item_data_loader"):
        ll.run_signals(tables, {"AccrualAlert": INVOICES_ONLY})
    with pytest.raises(ValueError, match="detector output lacks: invoice_id"):
        ll.conform(ll.missing_invoices(tables["inv"]), 9, 1)


def test_a_detector_of_ones_own(tables):
    def unpaid(invoices, floor=0):
        return invoices.where(F.col("total_amount") > floor).select(
            "canonical_vendor_id",
            F.to_date("invoice_date").alias("insight_date"),
            F.lit("large").alias("insight_text"),
        )

    signal = ll.Signal(unpaid, 5, 2, {"invoice_data_loader": "invoices"})
    ll.register_signal("Unpaid", signal)
    try:
        alerts = ll.run_signals(tables, {"Unpaid": {**INVOICES_ONLY, "floor": 1000}})
        assert found(alerts, "glean_type", "invoice_id", "glean_text") == [(5, None, "large")]
        assert found(ll.with_names(alerts), "glean_type", "glean_location") == [("unpaid", "vendor")]
        with pytest.raises(ValueError, match="already registered"):
            ll.register_signal("Again", signal)
    finally:
        del registry.SIGNALS["Unpaid"]


def test_other_column_names(tables):
    names = ll.InvoiceColumns(
        vendor="supplier", invoice="bill", date="billed", amount="sum", period_end="until"
    )
    renamed = tables["inv"].toDF("supplier", "bill", "billed", "sum", "until")
    renamed_lines = tables["li"].toDF("bill", "line_item_id", "until")
    keys = ("canonical_vendor_id", "insight_date", "insight_text")
    for rules in ("code", "documented"):
        for detect, usual, other in (
            (ll.dormant_vendors, (tables["inv"],), (renamed,)),
            (ll.accrual_alerts, (tables["inv"], tables["li"]), (renamed, renamed_lines)),
            (ll.large_months, (tables["inv"],), (renamed,)),
            (ll.missing_invoices, (tables["inv"],), (renamed,)),
        ):
            expected = found(detect(*usual, rules=rules), *keys)
            assert expected and found(detect(*other, rules=rules, columns=names), *keys) == expected


def test_column_names_as_a_mapping(tables):
    renamed = tables["inv"].withColumnsRenamed({"canonical_vendor_id": "supplier"})
    settings = {"VendorNotSeenInAWhile": {**INVOICES_ONLY, "columns": {"vendor": "supplier"}}}
    given = {"VendorNotSeenInAWhile": INVOICES_ONLY}
    names = ll.ALERT_SCHEMA.names
    assert found(ll.run_signals({"inv": renamed}, settings), *names) == found(ll.run_signals(tables, given), *names)


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz"])
def test_other_date_types(tables, kind):
    cast = {
        name: df.withColumns(
            {c: F.col(c).cast(kind) for c in df.columns if c.endswith("_date")}
        )
        for name, df in tables.items()
    }
    names = ("glean_date", "glean_text", "glean_type", "invoice_id")
    for rules in ("code", "documented"):
        expected = found(ll.run_signals(tables, ALL, rules=rules), *names)
        assert found(ll.run_signals(cast, ALL, rules=rules), *names) == expected


def test_current_date_as_text(tables):
    early = {"NoInvoiceReceived": {**INVOICES_ONLY, "as_of": "2020-04-20"}}
    late = {"NoInvoiceReceived": {**INVOICES_ONLY, "as_of": "2020-08-01"}}
    assert ll.run_signals(tables, early).count() == 11  # from the 10th up to the stated day
    assert ll.run_signals(tables, late).count() == ll.run_signals(
        tables, {"NoInvoiceReceived": INVOICES_ONLY}
    ).count()
    assert monthly_misses(tables["inv"], as_of="2020-03-31").count() == 0
