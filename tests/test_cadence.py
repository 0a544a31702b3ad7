import random
from collections import Counter
from datetime import date, timedelta

import pytest

from ledgerlark import Cadence, missing_invoices, run_signals
from ledgerlark.operators.cadence import (
    cadence_misses,
    daily,
    monthly_misses,
    quarterly_misses,
    without_monthly,
)
from tests.helpers import day, found, invoices

SPAN = ("vendor", "cadence", "start", "end")


def billed(vendor, *dates):
    return [(vendor, f"{vendor}{d}", d) for d in dates]


def span(vendor, *dates):
    return (vendor, *[day(d) for d in dates])


def test_month_after_three_active_ones(spark):
    table = invoices(
        spark,
        *billed("v", "2020-01-10", "2020-02-12", "2020-03-08"),
        *billed("late", "2020-01-10", "2020-02-12", "2020-03-08", "2020-04-15"),
        *billed("in-time", "2020-01-10", "2020-02-12", "2020-03-08", "2020-04-10"),
        *billed("gap", "2020-01-10", "2020-03-08"),
        *billed("newest", "2020-04-20"),
    )
    assert found(monthly_misses(table), *SPAN) == [
        span("late", "2020-04-01", "2020-04-10", "2020-04-15"),
        span("v", "2020-04-01", "2020-04-10", "2020-05-01"),
    ]


def test_newest_cadence_is_that_of_the_whole_table(spark):
    alone = invoices(spark, *billed("v", "2020-01-10", "2020-02-12", "2020-03-08"))
    assert found(monthly_misses(alone), *SPAN) == []
    assert found(monthly_misses(alone, as_of=date(2020, 4, 2)), *SPAN) == [
        span("v", "2020-04-01", "2020-04-10", "2020-05-01")
    ]
    assert found(monthly_misses(alone, as_of=date(2020, 2, 2)), *SPAN) == []


def test_days_a_month_does_not_have(spark):
    table = invoices(
        spark,
        *billed("v", "2020-01-31", "2020-02-12", "2020-03-08"),
        *billed("feb", "2019-11-30", "2019-12-12", "2020-01-08"),
        *billed("newest", "2020-04-20"),
    )
    assert found(monthly_misses(table), *SPAN) == []
    clamped = monthly_misses(table, rules="documented")
    assert found(clamped, *SPAN) == [
        span("feb", "2020-02-01", "2020-02-08", "2020-03-01"),
        span("v", "2020-04-01", "2020-04-08", "2020-05-01"),
    ]


def test_quarters(spark):
    table = invoices(
        spark,
        *billed("v", "2020-02-10", "2020-06-12"),
        *billed("third-month", "2020-02-10", "2020-06-12", "2020-09-20"),
        *billed("newest", "2020-07-20"),
    )
    assert found(quarterly_misses(table), *SPAN) == [
        span("third-month", "2020-07-01", "2020-07-10", "2020-09-20"),
        span("v", "2020-07-01", "2020-07-10", "2020-08-01"),
    ]
    assert found(quarterly_misses(table, rules="documented"), *SPAN) == [
        span("third-month", "2020-07-01", "2020-07-10", "2020-08-01"),
        span("v", "2020-07-01", "2020-07-10", "2020-08-01"),
    ]


def test_quarterly_is_dropped_where_a_month_of_it_was_missed(spark):
    table = invoices(
        spark,
        *billed("v", "2020-01-10", "2020-04-10", "2020-05-10", "2020-06-10"),
        *billed("newest", "2020-08-20"),
    )
    monthly, quarterly = monthly_misses(table), quarterly_misses(table)
    assert found(monthly, *SPAN) == [span("v", "2020-07-01", "2020-07-10", "2020-08-01")]
    assert found(quarterly, *SPAN) == [span("v", "2020-07-01", "2020-07-10", "2020-08-01")]
    assert found(without_monthly(quarterly, monthly), *SPAN) == []
    assert missing_invoices(table).count() == 22


def test_documented_quarter_needs_a_single_invoice(spark):
    table = invoices(
        spark,
        *billed("two", "2020-02-10", "2020-03-10", "2020-06-12"),
        ("twice", "same", "2020-02-10"),
        ("twice", "same", "2020-03-10"),
        ("twice", "next", "2020-06-12"),
        *billed("newest", "2020-07-20"),
    )
    assert [row[0] for row in found(quarterly_misses(table), *SPAN)] == ["twice", "two"]
    assert [row[0] for row in found(quarterly_misses(table, rules="documented"), *SPAN)] == [
        "twice"
    ]


def test_documented_day_is_the_most_frequent_one(spark):
    table = invoices(
        spark,
        *billed("v", "2020-01-02", "2020-01-15", "2020-02-15", "2020-03-20", "2020-03-20"),
        *billed("tie", "2020-01-25", "2020-02-09", "2020-03-17"),
        *billed("newest", "2020-04-20"),
    )
    assert found(monthly_misses(table, rules="documented"), *SPAN) == [
        span("tie", "2020-04-01", "2020-04-09", "2020-05-01"),
        span("v", "2020-04-01", "2020-04-15", "2020-05-01"),
    ]


def test_daily_rows_stop_before_the_end(spark):
    spans = spark.sql(
        """SELECT * FROM VALUES
        ('one', DATE'2020-02-28', DATE'2020-02-29'), ('leap', DATE'2020-02-28', DATE'2020-03-02'),
        ('none', DATE'2020-02-28', DATE'2020-02-28'),
        ('reversed', DATE'2020-02-28', DATE'2020-02-01'), ('null', NULL, DATE'2020-02-01') AS t(vendor, start, end)"""
    )
    assert found(daily(spans), "vendor", "date") == [
        ("leap", day("2020-02-28")),
        ("leap", day("2020-02-29")),
        ("leap", day("2020-03-01")),
        ("one", day("2020-02-28")),
    ]


def test_text(spark):
    table = invoices(
        spark,
        *billed("v", "2020-01-30", "2020-02-12", "2020-03-08"),
        *billed("newest", "2020-04-20"),
    )
    sentence = (
        "`v` generally charges between on 30 day of each month invoices are sent. "
        "On 2020-04-30, an invoice from `v` has not been received."
    )
    names = ("canonical_vendor_id", "insight_date", "insight_text")
    assert found(missing_invoices(table), *names) == [("v", day("2020-04-30"), sentence)]


def test_null_vendors_null_ids_and_empty_input(spark):
    months = ("2020-01-10", "2020-02-12", "2020-03-08")
    table = invoices(
        spark,
        *[(None, f"n{d}", d) for d in months],
        *[("no-ids", None, d) for d in months],
        ("no-dates", "x", None),
        *billed("present", *months),
        ("present", None, "2020-04-12"),
        *billed("newest", "2020-04-20"),
    )
    assert found(monthly_misses(table), *SPAN) == [
        span("present", "2020-04-01", "2020-04-10", "2020-04-12")
    ]
    assert missing_invoices(table.limit(0)).count() == 0


def test_no_alert_after_the_stated_day(spark):
    steady = invoices(spark, *[("v", f"i{m}", f"2020-{m:02}-05") for m in (1, 2, 3)])
    dates = [r[0] for r in found(missing_invoices(steady, as_of="2020-04-10"), "insight_date")]
    assert dates and str(max(dates)) == "2020-04-10"


def period_of(cadence, d):
    if cadence.unit == "month":
        return (d.year * 12 + d.month - cadence.starts) // cadence.length
    return ((d - date(1970, 1, 5)).days - cadence.starts + 1) // (7 * cadence.length)


def period_start(cadence, p):
    if cadence.unit == "month":
        month = p * cadence.length + cadence.starts - 1
        return date(month // 12, month % 12 + 1, 1)
    return date(1970, 1, 5) + timedelta(7 * cadence.length * p + cadence.starts - 1)


def plain_misses(rows, cadence, documented):
    """Every vendor and every period, one after the other."""
    newest = max(d for _, _, d in rows)
    out = []
    for vendor in {v for v, _, _ in rows}:
        periods = {}
        for v, i, d in rows:
            if v == vendor:
                periods.setdefault(period_of(cadence, d), set()).add((d, i))
        for p in range(min(periods), period_of(cadence, newest) + 1):
            before = [periods.get(q, set()) for q in range(p - cadence.lookback, p)]
            if not all(before):
                continue
            start = period_start(cadence, p)
            if cadence.unit == "month":
                due = (start.replace(day=28) + timedelta(4)).replace(day=1)
                place = lambda d: d.day
            else:
                due = start + timedelta(7 * cadence.length)
                place = lambda d: (d - period_start(cadence, period_of(cadence, d))).days + 1
            first = min(periods[p])[0] if p in periods else None
            if documented:
                if cadence.unit == "month" and cadence.length > 1 and any(len({i for _, i in b}) != 1 for b in before):
                    continue
                days = Counter(place(d) for b in before for d, _ in b)
                usual = min(days, key=lambda x: (-days[x], x))
                end = min(first or due, due)
            else:
                usual, end = place(min(before[0])[0]), first or due
            begin = start + timedelta(usual - 1)
            if cadence.unit == "month" and begin.month != start.month:
                if not documented:
                    continue
                begin = due - timedelta(1)
            if end > begin:
                out.append((vendor, start, usual, begin, end))
    return sorted(out, key=lambda row: tuple(map(str, row)))


@pytest.mark.parametrize("rules", ["code", "documented"])
@pytest.mark.parametrize(
    "cadence",
    [
        Cadence("week", 1, 3), Cadence("week", 2, 1, starts=7), Cadence("week", 3, 2, starts=4), Cadence("month", 1, 1),
        Cadence("month", 3, 2, starts=2), Cadence("month", 6, 2, starts=4), Cadence("month", 12, 1, starts=10),
    ],
)
def test_any_cadence_against_every_period(spark, cadence, rules):
    r = random.Random(f"{cadence}")
    spread = cadence.days
    rows = [
        (f"v{n % 6}", f"i{n % 90 if n % 5 else n // 2}", date(2019, 1, 1) + timedelta(r.randrange(spread * 9)))
        for n in range(120)
    ]
    table = invoices(spark, *[(v, i, str(d)) for v, i, d in rows])
    names = ("vendor", "cadence", "usual_day", "start", "end")
    expected = plain_misses(rows, cadence, rules == "documented")
    assert expected
    assert found(cadence_misses(table, cadence, rules=rules), *names) == expected


def test_cadences_from_a_configuration(spark):
    weekly = billed("v", "2020-01-07", "2020-01-14", "2020-01-21") + billed("w", "2020-02-03")
    table = invoices(spark, *weekly)
    settings = {"NoInvoiceReceived": {"invoice_data_loader": "t", "cadences": [{"unit": "week", "lookback": 2}, "quarter"]}}
    alerts = found(run_signals({"t": table}, settings), "glean_date", "glean_text")
    text = "`v` generally charges between on 2 day of each week invoices are sent. "
    text += "On 2020-01-{}, an invoice from `v` has not been received."
    assert alerts == [(day(f"2020-01-{d}"), text.format(d)) for d in (28, 29, 30, 31)] + [
        (day("2020-02-01"), text.format("x").replace("01-x", "02-01")), (day("2020-02-02"), text.format("x").replace("01-x", "02-02"))
    ]
    with pytest.raises(ValueError):
        run_signals({"t": table}, {"NoInvoiceReceived": {"invoice_data_loader": "t", "cadences": ["decade"]}})
    with pytest.raises(ValueError):
        Cadence("month", 3, starts=13)
    with pytest.raises(ValueError):
        missing_invoices(table, cadences=[])


def test_bands_from_a_configuration(spark):
    rows = [("v", f"i{m}", f"2020-{m:02d}-05", 10) for m in range(1, 12)] + [("v", "big", "2020-12-05", 90)]
    table = invoices(spark, *rows)
    settings = {"LargeMonthIncreaseMtd": {"invoice_data_loader": "t", "bands": [{"low": 50, "high": 99, "percent": 100}]}}
    assert run_signals({"t": table}, settings).count() == 1
    settings["LargeMonthIncreaseMtd"]["bands"][0]["low"] = 90
    assert run_signals({"t": table}, settings).count() == 0
