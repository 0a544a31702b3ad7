import pytest

from ledgerlark import dormant_vendors
from tests.helpers import day, found, invoices

COLUMNS = ("canonical_vendor_id", "invoice_id", "insight_date", "insight_text")


def text(months, vendor="v"):
    return f"First new bill in {months} months from vendor `{vendor}`"


def test_gap_must_exceed_the_window(spark):
    table = invoices(
        spark,
        ("v", "first", "2020-01-01"),
        ("v", "at-90", "2020-03-31"),
        ("v", "at-91", "2020-06-30"),
        ("w", "only", "2020-06-30"),
    )
    assert found(dormant_vendors(table), *COLUMNS) == [
        ("v", "at-91", day("2020-06-30"), text(3))
    ]
    assert found(dormant_vendors(table, window=91), "invoice_id") == []


def test_gap_counts_calendar_days_not_hours(spark):
    table = invoices(spark, ("v", "a", "2020-01-01 23:59"), ("v", "b", "2020-04-01 00:01"))
    assert found(dormant_vendors(table), "invoice_id") == [("b",)]
    short = invoices(spark, ("v", "a", "2020-01-01 00:01"), ("v", "b", "2020-03-31 23:59"))
    assert found(dormant_vendors(short), "invoice_id") == []


def test_one_alert_per_day_with_the_lowest_date_then_id(spark):
    table = invoices(
        spark,
        ("v", "a", "2020-01-01"),
        ("v", "z", "2020-06-01"),
        ("v", "m", "2020-06-01"),
        ("w", "a", "2020-01-01"),
        ("w", "b", "2020-06-01 08:00"),
        ("w", "c", "2020-06-01 07:00"),
    )
    assert found(dormant_vendors(table), "canonical_vendor_id", "invoice_id") == [
        ("v", "m"),
        ("w", "c"),
    ]


def test_an_invoice_on_two_dates_counts_at_its_latest(spark):
    table = invoices(
        spark, ("v", "a", "2020-01-01"), ("v", "b", "2020-02-01"), ("v", "b", "2020-08-01")
    )
    assert found(dormant_vendors(table), "invoice_id", "insight_date") == [
        ("b", day("2020-08-01"))
    ]


def test_month_ends_count_as_whole_months(spark):
    table = invoices(spark, ("v", "a", "2021-02-28"), ("v", "b", "2021-05-31"))
    assert found(dormant_vendors(table), "insight_text") == [(text(3),)]


def test_null_dates_and_null_vendors(spark):
    table = invoices(
        spark,
        ("v", "a", None),
        ("v", "b", "2020-06-01"),
        (None, "c", "2020-01-01"),
        (None, "d", "2020-06-01"),
    )
    assert found(dormant_vendors(table), *COLUMNS) == [(None, "d", day("2020-06-01"), None)]


def test_documented_wording(spark):
    table = invoices(spark, ("v", "a", "2020-01-01"), ("v", "b", "2020-06-01"))
    assert found(dormant_vendors(table, rules="documented"), "insight_text") == [
        ("First new bill in 5 months from vendor v",)
    ]


def test_bad_arguments(spark):
    table = invoices(spark, ("v", "a", "2020-01-01"))
    with pytest.raises(ValueError, match="negative"):
        dormant_vendors(table, window=-1)
    with pytest.raises(TypeError, match="invoice_date is missing"):
        dormant_vendors(table.drop("invoice_date"))
    with pytest.raises(TypeError, match="invoice_id is int"):
        dormant_vendors(table.selectExpr("canonical_vendor_id", "1 AS invoice_id", "invoice_date"))
