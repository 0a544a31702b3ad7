"""Brute-force rules on Python rows, for random tables far smaller than the library is meant for.

Rows are (vendor, invoice, datetime or None, Decimal or None).
"""

from __future__ import annotations

import calendar
import math
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal


def _order(value):
    return (value is not None, value or "")


def month_of(d):
    return date(d.year, d.month, 1)


def add_months(d, n):
    index = d.year * 12 + d.month - 1 + n
    return date(index // 12, index % 12 + 1, 1)


def quarter_of(d):
    return date(d.year, (d.month - 1) // 3 * 3 + 1, 1)


def months_between(a: datetime, b: datetime) -> int:
    def last(d):
        return d.day == calendar.monthrange(d.year, d.month)[1]

    whole = (a.year - b.year) * 12 + a.month - b.month
    if a.day == b.day or (last(a) and last(b)):
        return whole
    seconds = (
        (a.day - b.day) * 86400
        + (a.hour - b.hour) * 3600
        + (a.minute - b.minute) * 60
        + (a.second - b.second)
    )
    return math.floor(whole + seconds / (31 * 86400))


def latest(rows):
    out = {}
    for vendor, invoice, issued, _ in rows:
        key = (vendor, invoice)
        if key not in out or (issued is not None and (out[key] is None or issued > out[key])):
            out[key] = issued
    return out


def previous(rows):
    """{(vendor, invoice): (date, previous date)} in (date, invoice id) order."""
    vendors = defaultdict(list)
    for (vendor, invoice), issued in latest(rows).items():
        vendors[vendor].append((_order(issued), _order(invoice), issued, invoice))
    out = {}
    for vendor, items in vendors.items():
        before = None
        for _, _, issued, invoice in sorted(items, key=lambda item: item[:2]):
            out[(vendor, invoice)] = (issued, before)
            before = issued
    return out


def dormant(rows, window=90):
    out = []
    for (vendor, invoice), (issued, before) in previous(rows).items():
        if before and (issued.date() - before.date()).days > window:
            out.append((vendor, invoice, issued.date(), months_between(issued, before)))
    return out


def accrual(rows, ends, window=90):
    """``ends`` are (invoice, period end)."""
    last = {}
    for invoice, end in ends:
        if invoice is not None and end is not None:
            last[invoice] = max(end, last.get(invoice, end))
    out = set()
    for vendor, invoice, issued, _ in rows:
        if issued is None or invoice not in last:
            continue
        limit = datetime.combine(issued.date() + timedelta(days=window), datetime.min.time())
        if last[invoice] > limit:
            out.add((vendor, invoice, issued, last[invoice].date()))
    return [(v, i, d.date(), end) for v, i, d, end in out]


def large(rows):
    amounts = {}
    for vendor, invoice, issued, amount in rows:
        if issued is not None:
            key = (vendor, invoice, issued)
            known = amounts.get(key)
            amounts[key] = amount if known is None else max(known, amount or known)
    spend = defaultdict(list)
    for (vendor, _, issued), amount in amounts.items():
        spend[(vendor, month_of(issued))].append(amount)
    totals = {
        key: sum(known) if (known := [a for a in values if a is not None]) else None
        for key, values in spend.items()
    }
    out = []
    for (vendor, month), total in totals.items():
        if total is None or total <= 0:
            continue
        history = [
            t
            for (v, m), t in totals.items()
            if v == vendor and t is not None and month - timedelta(days=365) <= m <= month
        ]
        average = sum(history) / Decimal(len(history))
        if average <= 0:
            continue
        percent = 100 * (total - average) / average
        if (
            (total > 10000 and percent > 50)
            or (1000 < total < 10000 and percent > 200)
            or (100 < total < 1000 and percent > 500)
        ):
            shown = average.quantize(Decimal("0.01"), ROUND_HALF_UP)
            out.append((vendor, month, total.quantize(Decimal("0.01")), shown))
    return out


def _missed(rows, cadence_of, step, lookback):
    dated = [(v, i, d.date()) for v, i, d, _ in rows if d is not None]
    if not dated:
        return {}
    cells = defaultdict(list)
    for vendor, invoice, d in dated:
        cells[(vendor, cadence_of(d))].append((d, invoice))
    first = min(cadence_of(d) for _, _, d in dated)
    last = max(cadence_of(d) for _, _, d in dated)
    out = {}
    for vendor in {v for v, _, _, _ in rows if v is not None}:
        at = first
        while at <= last:
            earlier = [cells.get((vendor, add_months(at, -step * k)), []) for k in
                       range(1, lookback + 1)]
            if all(any(i is not None for _, i in cell) for cell in earlier):
                usual = min(d for cell in earlier for d, _ in cell).day
                here = cells.get((vendor, at))
                end = min(d for d, _ in here) if here else add_months(at, 1)
                if usual <= calendar.monthrange(at.year, at.month)[1]:
                    start = at.replace(day=usual)
                    if end > start:
                        out[(vendor, at)] = (start, end)
            at = add_months(at, step)
    return out


def monthly_misses(rows):
    return _missed(rows, month_of, 1, 3)


def quarterly_misses(rows):
    return _missed(rows, quarter_of, 3, 2)


def missing_days(rows):
    monthly = monthly_misses(rows)
    hit_quarters = {(v, quarter_of(at)) for v, at in monthly}
    spans = dict(monthly)
    spans.update({("q", k): s for k, s in quarterly_misses(rows).items() if k not in hit_quarters})
    out = []
    for key, (start, end) in spans.items():
        vendor = key[1][0] if key[0] == "q" and isinstance(key[1], tuple) else key[0]
        d = start
        while d < end:
            out.append((vendor, d, start.day))
            d += timedelta(days=1)
    return out
