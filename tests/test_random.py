"""Detectors against brute force on random tables with copies, ties, NULLs and times of day."""

import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlark import accrual_alerts, dormant_vendors, large_months, missing_invoices
from ledgerlark.operators import cadence, grid
from ledgerlark.operators.invoices import (
    invoice_lines,
    latest_invoice_dates,
    with_previous_invoice,
)
from ledgerlark.schema import InvoiceColumns
from tests import model
from tests.helpers import INVOICES, LINES, found, misses_on_grid


def random_rows(seed):
    """A third of all rows belongs to one vendor, and another tenth to one of its days."""
    rng = random.Random(seed)
    start = datetime(2018, 11, 1)
    rows = []
    for n in range(900):
        vendor = "hot" if rng.random() < 0.33 else rng.choice(["a", "b", "c", "d`e", "", None])
        moment = start + timedelta(days=rng.randrange(900))
        if rng.random() < 0.4:
            moment += timedelta(seconds=rng.randrange(86400), microseconds=rng.randrange(3))
        if rng.random() < 0.1:
            vendor, moment = "hot", datetime(2019, 3, 31)
        if rng.random() < 0.03:
            moment = None
        invoice = None if rng.random() < 0.02 else f"i{rng.randrange(700)}"
        amount = None if rng.random() < 0.05 else Decimal(rng.randrange(-5000, 900000)) / 100
        if rng.random() < 0.05 and amount is not None:
            amount *= 100
        rows.append((vendor, invoice, moment, amount))
    for n in range(60):  # regular vendors, some with a gap
        for month in range(18):
            if rng.random() < 0.9 and n % 6 == 0:
                issued = datetime(2019 + month // 12, month % 12 + 1, rng.randrange(1, 32 - 3))
                rows.append((f"m{n}", f"m{n}-{month}", issued, Decimal(100)))
            if month % 3 == 1 and n % 6 == 1 and rng.random() < 0.8:
                issued = datetime(2019 + month // 12, month % 12 + 1, rng.randrange(1, 32 - 3))
                rows.append((f"q{n}", f"q{n}-{month}", issued, Decimal(100)))
    return rows + rng.sample(rows, 100)


def random_ends(seed):
    rng = random.Random(seed + 1000)
    start = datetime(2018, 11, 1)
    return [
        (
            rng.choice([None, "none"]) if rng.random() < 0.02 else f"i{rng.randrange(700)}",
            None if rng.random() < 0.05 else start + timedelta(hours=rng.randrange(24 * 1000)),
        )
        for _ in range(900)
    ]


@pytest.fixture(scope="module", params=[1, 2])
def tables(request, spark):
    rows, ends = random_rows(request.param), random_ends(request.param)
    invoices = spark.createDataFrame([(*row, None) for row in rows], INVOICES).cache()
    lines = spark.createDataFrame([(i, f"l{n}", e) for n, (i, e) in enumerate(ends)], LINES)
    return rows, ends, invoices, lines


def ordered(rows):
    return sorted(
        (tuple(row) for row in rows), key=lambda row: tuple((v is not None, str(v)) for v in row)
    )


def test_previous_invoice(tables):
    rows, _, invoices, _ = tables
    ours = with_previous_invoice(latest_invoice_dates(invoices, InvoiceColumns()))
    expected = [(v, i, d, p) for (v, i), (d, p) in model.previous(rows).items()]
    assert found(ours, "vendor", "invoice", "issued", "previous") == ordered(expected)


def test_dormant(tables):
    rows, _, invoices, _ = tables
    ours = dormant_vendors(invoices, window=20)
    expected = [
        (v, i, d, None if v is None else f"First new bill in {m} months from vendor `{v}`")
        for v, i, d, m in model.dormant(rows, window=20)
    ]
    assert len(expected) > 50
    names = ("canonical_vendor_id", "invoice_id", "insight_date", "insight_text")
    assert found(ours, *names) == ordered(expected)


def test_accrual(tables):
    rows, ends, invoices, lines = tables
    ours = accrual_alerts(invoices, lines)
    expected = [
        (
            v,
            i,
            d,
            None
            if v is None
            else f"Line items from vendor `{v}` in this invoice cover future periods ({end})",
        )
        for v, i, d, end in model.accrual(rows, ends)
    ]
    assert len(expected) > 50
    names = ("canonical_vendor_id", "invoice_id", "insight_date", "insight_text")
    assert found(ours, *names) == ordered(expected)


def test_large_months(tables):
    rows, _, invoices, _ = tables
    expected = [
        (
            v,
            month,
            None
            if v is None
            else f"Monthly spend with `{v}` is ${spend} ({average}%) higher than average.",
        )
        for v, month, spend, average in model.large(rows)
    ]
    assert len(expected) > 3
    names = ("canonical_vendor_id", "insight_date", "insight_text")
    assert found(large_months(invoices), *names) == ordered(expected)


def test_missing_invoices(tables):
    rows, _, invoices, _ = tables
    expected = [
        (
            v,
            d,
            f"`{v}` generally charges between on {usual} day of each month invoices are sent. "
            f"On {d}, an invoice from `{v}` has not been received.",
        )
        for v, d, usual in model.missing_days(rows)
    ]
    assert len(expected) > 50
    ours = missing_invoices(invoices)
    names = ("canonical_vendor_id", "insight_date", "insight_text")
    assert found(ours, *names) == ordered(expected)
    per_day = ours.groupBy("canonical_vendor_id", "insight_date").count()
    assert per_day.where("count > 1").count() == 0


@pytest.mark.parametrize("unit", ["month", "quarter"])
def test_runs_of_active_cells_agree_with_the_grid(tables, unit):
    _, _, invoices, _ = tables
    names = ("vendor", "cadence", "start", "end")
    find = cadence.monthly_misses if unit == "month" else cadence.quarterly_misses
    on_grid = misses_on_grid(invoices, unit, cadence.LOOKBACK[unit])
    rows = found(find(invoices), *names)
    assert rows and rows == found(on_grid, *names)


def test_one_pass_over_misses_agrees_with_the_anti_join(tables):
    _, _, invoices, _ = tables
    monthly, quarterly = cadence.monthly_misses(invoices), cadence.quarterly_misses(invoices)
    names = ("vendor", "cadence", "start", "end")
    joined = monthly.unionByName(cadence.without_monthly(quarterly, monthly))
    assert found(cadence.either_cadence(monthly, quarterly), *names) == found(joined, *names)


def test_copies_change_nothing(tables):
    _, _, invoices, lines = tables
    twice, lines_twice = invoices.unionAll(invoices), lines.unionAll(lines)
    for rules in ("code", "documented"):
        for detect, once, again in (
            (dormant_vendors, (invoices,), (twice,)),
            (accrual_alerts, (invoices, lines), (twice, lines_twice)),
            (large_months, (invoices,), (twice,)),
            (missing_invoices, (invoices,), (twice,)),
        ):
            names = ("canonical_vendor_id", "insight_date", "insight_text")
            assert found(detect(*once, rules=rules), *names) == found(
                detect(*again, rules=rules), *names
            )


def test_invoice_lines_is_a_left_join(tables):
    rows, ends, invoices, lines = tables
    by_invoice = {}
    for n, (invoice, end) in enumerate(ends):
        by_invoice.setdefault(invoice, []).append((f"l{n}", end))
    expected = []
    for vendor, invoice, issued, _ in rows:
        matches = by_invoice.get(invoice, []) if invoice is not None else []
        for line, end in matches or [(None, None)]:
            expected.append((invoice, vendor, issued, line, end))
    joined = invoice_lines(invoices, lines).select(
        "invoice", "vendor", "issued", "line_item", "period_end"
    )
    assert Counter(tuple(row) for row in joined.collect()) == Counter(expected)


def test_grid_with_invoices_is_a_left_join(tables):
    _, _, invoices, _ = tables
    facts = grid.invoices_by_cadence(invoices, "quarter").withColumnsRenamed(
        {"vendor": "v", "cadence": "c"}
    )
    cells = grid.vendor_calendar(invoices, "quarter")
    direct = cells.join(
        facts, (F.col("vendor") == F.col("v")) & (F.col("cadence") == F.col("c")), "left"
    )
    names = ("vendor", "cadence", "invoice", "day")
    ours = grid.grid_with_invoices(invoices, "quarter")
    # a NULL vendor has cells, but no invoice ever matches them
    assert found(ours, *names) == found(direct, *names)
