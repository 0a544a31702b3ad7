from ledgerlark import accrual_alerts
from tests.helpers import day, found, invoices, lines

COLUMNS = ("canonical_vendor_id", "invoice_id", "insight_date", "insight_text")


def text(end, vendor="v"):
    return f"Line items from vendor `{vendor}` in this invoice cover future periods ({end})"


def test_end_must_lie_past_the_window(spark):
    table = invoices(
        spark,
        ("v", "on-day-90", "2020-01-01 15:00"),
        ("v", "on-day-90-later", "2020-01-01 15:00"),
        ("v", "day-91", "2020-01-01"),
        ("v", "no-lines", "2020-01-01"),
        ("v", "null-end", "2020-01-01"),
    )
    ends = lines(
        spark,
        ("on-day-90", "2020-03-31"),
        ("on-day-90-later", "2020-03-31 10:00"),
        ("day-91", "2020-04-01"),
        ("null-end", None),
    )
    assert found(accrual_alerts(table, ends), *COLUMNS) == [
        ("v", "day-91", day("2020-01-01"), text("2020-04-01")),
        ("v", "on-day-90-later", day("2020-01-01"), text("2020-03-31")),
    ]


def test_the_latest_end_wins_and_copies_do_not_multiply(spark):
    table = invoices(spark, ("v", "a", "2020-01-01"), ("v", "a", "2020-01-01"))
    ends = lines(
        spark, ("a", "2020-05-01"), ("a", "2020-09-01"), ("a", None), ("a", "2020-09-01")
    )
    assert found(accrual_alerts(table, ends), "insight_text") == [(text("2020-09-01"),)]


def test_each_date_of_an_invoice_is_judged_alone(spark):
    table = invoices(spark, ("v", "a", "2020-01-01"), ("v", "a", "2020-06-01"))
    ends = lines(spark, ("a", "2020-06-30"))
    assert found(accrual_alerts(table, ends), "insight_date") == [(day("2020-01-01"),)]


def test_null_vendor_has_no_text_and_null_invoice_no_lines(spark):
    table = invoices(spark, (None, "a", "2020-01-01"), ("v", None, "2020-01-01"))
    ends = lines(spark, ("a", "2020-06-30"), (None, "2020-06-30"))
    assert found(accrual_alerts(table, ends), *COLUMNS) == [(None, "a", day("2020-01-01"), None)]


def test_documented_rule_counts_the_invoice_period(spark):
    table = invoices(
        spark,
        ("v", "own", "2020-01-01", 1, "2020-07-01"),
        ("v", "both", "2020-01-01", 1, "2020-07-01"),
        ("v", "neither", "2020-01-01", 1, None),
    )
    ends = lines(spark, ("both", "2020-08-01"))
    assert found(accrual_alerts(table, ends), "invoice_id") == [("both",)]
    documented = accrual_alerts(table, ends, rules="documented")
    assert found(documented, "invoice_id", "insight_text") == [
        (name, f"Line items from vendor v in this invoice cover future periods (through {end})")
        for name, end in (("both", "2020-08-01"), ("own", "2020-07-01"))
    ]
