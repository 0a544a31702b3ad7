"""Alerts kept up to date by batches against one run over all rows."""

import random
import shutil
from datetime import date, timedelta

import pytest

from ledgerlark import SignalState, VersionConflict, run_signals
from ledgerlark.plans import increments
from ledgerlark.sources.versions import VersionedFolder
from tests.helpers import invoices, lines

SETTINGS = {
    "VendorNotSeenInAWhile": {"invoice_data_loader": "inv"},
    "AccrualAlert": {"invoice_data_loader": "inv", "line_item_data_loader": "lines"},
    "LargeMonthIncreaseMtd": {"invoice_data_loader": "inv"},
    "NoInvoiceReceived": {"invoice_data_loader": "inv"},
}
NAMES = ["glean_id", "glean_date", "glean_text", "glean_type", "glean_location", "invoice_id", "canonical_vendor_id"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=str)


def whole_run(spark, bills, items):
    return rows_of(run_signals({"inv": invoices(spark, *bills), "lines": lines(spark, *items)}, SETTINGS))


def history(seed):
    """Vendors with steady months, gaps, copies, corrected dates and amounts, and missing values."""
    r = random.Random(seed)
    bills, items = [], []
    for n in range(160):
        vendor = r.choice(["a", "a", "a", "b", "c", None])
        day = date(2020, 1, 1) + timedelta(r.randrange(900))
        amount = r.choice([r.randrange(90, 20_000), None, -500, 50_000])
        clock = r.choice(["", " 10:30", " 23:59"])
        invoice = r.choice([f"i{n}", f"i{n % 70}", None if n % 40 == 0 else f"i{n}"])
        bills.append((vendor, invoice, r.choice([f"{day}{clock}"] * 15 + [None]), amount))
        if r.random() < 0.5:
            items.append((invoice, r.choice([f"{day + timedelta(r.randrange(60, 140))}", None])))
    return bills, items


def test_batches_give_what_one_run_gives(spark, tmp_path):
    bills, items = history(3)
    r = random.Random(1)
    r.shuffle(bills)  # late rows in every batch
    cuts, halves = [0, 80, 81, 160], [0, len(items) // 2, len(items)]
    state = SignalState(spark, str(tmp_path / "state"), buckets=2)
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        part = items[halves[n] : halves[n + 1]] if n < 2 else []
        version = state.apply(invoices(spark, *bills[a:b]), lines(spark, *part) if n < 2 else None)
        assert version == n + 1
    expected = whole_run(spark, bills, items)
    assert {row[3] for row in expected} == {1, 2, 3, 4}
    assert rows_of(state.alerts()) == expected
    again = SignalState(spark, str(tmp_path / "state"))
    assert (again.version, again.buckets) == (3, 2)
    again.compact()
    assert rows_of(again.alerts()) == expected
    assert again.table("rows").count() == len({b[:3] for b in bills})


def bucket_of(spark, state, vendor):
    return spark.createDataFrame([(vendor,)], "vendor string").select(state._bucket("vendor")).first()[0]


def test_other_buckets_are_not_read(spark, tmp_path):
    state = SignalState(spark, str(tmp_path), buckets=16)
    names = [f"v{n}" for n in range(12)]
    bills = [(v, f"{v}-{m}", f"2020-0{m}-05", 100) for v in names for m in (1, 2, 3)]
    state.apply(invoices(spark, *bills))
    own = bucket_of(spark, state, "v0")
    before = state.content["tables"]
    for name in ("rows", "days", "months", "month_misses"):
        for bucket, paths in before[name].items():
            if int(bucket) != own:
                for path in paths:
                    shutil.rmtree(path.removeprefix("file:"))  # a read would fail
    late = [("v0", "v0-9", "2020-06-20", 100)]
    state.apply(invoices(spark, *late))
    for name in ("days", "months", "month_misses"):
        changed = {b for b, paths in state.content["tables"][name].items() if before[name].get(b) != paths}
        assert changed <= {str(own)}
    found = state.table("dormant").collect()
    assert [(r["canonical_vendor_id"], r["invoice_id"]) for r in found] == [("v0", "v0-9")]


def test_newest_date_brings_up_misses_of_untouched_vendors(spark, tmp_path):
    bills = [("v", f"i{m}", f"2020-0{m}-10", 10) for m in (1, 2, 3)]
    state = SignalState(spark, str(tmp_path), buckets=4)
    state.apply(invoices(spark, *bills))
    assert rows_of(state.alerts()) == []
    later = [("other", "x", "2020-04-02", 10)]
    state.apply(invoices(spark, *later))
    assert len(rows_of(state.alerts())) == 21
    assert rows_of(state.alerts()) == whole_run(spark, bills + later, [])


def test_a_failed_or_second_run_leaves_the_version(spark, tmp_path):
    bills = [("v", f"i{m}", f"2020-0{m}-10", 10) for m in (1, 5)]
    state = SignalState(spark, str(tmp_path), buckets=2)
    state.apply(invoices(spark, *bills))
    other = SignalState(spark, str(tmp_path))
    kept = state.content
    broken = invoices(spark, ("v", "i9", "2021-01-01", 1)).drop("total_amount")
    with pytest.raises(Exception):
        state.apply(broken)
    assert state.content == kept and VersionedFolder(spark, str(tmp_path)).current() == (1, kept)
    state.apply(invoices(spark, ("v", "i7", "2020-12-10", 10)))
    with pytest.raises(VersionConflict):
        other.apply(invoices(spark, ("w", "j", "2020-12-10", 10)))
    assert other.version == 1 and SignalState(spark, str(tmp_path)).version == 2
    (tmp_path / "_versions" / "0000000003.json").write_text('{"buckets": 2, "win')  # its writer was stopped
    assert SignalState(spark, str(tmp_path)).version == 2
    assert SignalState(spark, str(tmp_path)).apply(invoices(spark, ("w", "j", "2020-12-10", 10))) == 4


def test_empty_batches(spark, tmp_path):
    state = SignalState(spark, str(tmp_path), buckets=2)
    state.apply(invoices(spark), lines(spark))
    assert rows_of(state.alerts()) == []
    state.apply(invoices(spark, ("v", "i", "2020-01-01", 1)))
    state.apply(invoices(spark), lines(spark, ("i", "2020-05-01")))
    assert [row[3] for row in rows_of(state.alerts())] == [2]


def test_a_large_batch_is_not_looked_up_in_its_buckets(spark, tmp_path, monkeypatch):
    bills, items = history(5)
    halves = [(bills[:80], items[:30]), (bills[80:], items[30:])]
    expected = whole_run(spark, bills, items)
    tables = {}
    for few in (0, increments.FEW):  # 0: every batch is looked up
        monkeypatch.setattr(increments, "FEW", few)
        if few:
            monkeypatch.setattr(increments, "_same", lambda *_: pytest.fail("a join with the batch"))
        state = SignalState(spark, str(tmp_path / f"state{few}"), buckets=2)
        for part, ends in halves:
            state.apply(invoices(spark, *part), lines(spark, *ends))
        assert rows_of(state.alerts()) == expected
        tables[few] = {name: sorted(map(str, state.table(name).collect())) for name in increments.REPLACED}
    assert tables[0] == tables[increments.FEW]


def test_rows_without_line_items_join_nothing(spark, tmp_path):
    state = SignalState(spark, str(tmp_path), buckets=2)
    state.apply(invoices(spark, ("v", "i", "2020-01-01", 1)))
    ends = state.table("ends")
    assert ends.columns == ["invoice", "period_end"] and ends.collect() == []
    joined = state.table("dates").join(ends, "invoice")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in joined and "Relation" not in joined.replace("LocalRelation", "")


def test_months_of_a_first_batch_take_one_exchange(spark, tmp_path, monkeypatch):
    exchanges, all_months = [], SignalState._all_months

    def counted(*given, **options):
        found = all_months(*given, **options)
        exchanges.append(found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return found

    monkeypatch.setattr(SignalState, "_all_months", counted)
    state = SignalState(spark, str(tmp_path), buckets=2)
    copies = [("v", "i", "2020-01-01", 1), ("v", "i", "2020-01-01", 5), ("v", "j", "2020-01-02", 2), ("v", "k", None, 9)]
    for amounts in ((7, 2), (10, 2)):
        state.apply(invoices(spark, *copies))
        assert [(int(r.spend), r.priced) for r in state.table("months").collect()] == [amounts]
        copies = [("v", "i", "2020-01-01", 8), ("v", "j", "2020-01-02", 1)]  # of the first batch's ids and dates
    assert exchanges == [1, 2]
