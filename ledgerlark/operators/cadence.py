"""Invoices expected on a cadence, such as every month or quarter, that did not arrive in time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions.dates import CADENCES, Cadence, cadence_start
from ledgerlark.functions.text import sentence
from ledgerlark.schema import DATE_LIKE, ID_LIKE, InvoiceColumns, require_rules, require_types

# Active cadences needed before the next one counts as expected.
LOOKBACK = {name: cadence.lookback for name, cadence in CADENCES.items()}
#: Days of a month that are counted apart.
DAYS = 31


def _counters(cadence: Cadence) -> list[str]:
    days = DAYS if cadence.unit == "month" else 7 * cadence.length
    return [f"n_{day}" for day in range(1, days + 1)]


def _base(cadence: Cadence) -> Cadence:
    """The periods that invoices are first counted in: all cadences of months share single months."""
    return Cadence("month", 1, 1) if cadence.unit == "month" else cadence


def _dated(invoices: DataFrame, columns: InvoiceColumns) -> DataFrame:
    return invoices.where(F.col(columns.date).isNotNull()).select(
        F.col(columns.vendor).alias("vendor"),
        F.col(columns.invoice).alias("invoice"),
        F.to_date(columns.date).alias("day"),
    )


def active_periods(
    invoices: DataFrame, cadence: Cadence, *, columns: InvoiceColumns = InvoiceColumns()
) -> DataFrame:
    """One row per (vendor, period) with any invoice: first and last day, whether any has an id, and
    whether the vendor is ``known``.

    A single map-side combined aggregation with fixed-width buffers. Rows of NULL vendors stay, as
    their dates count for the newest one.
    """
    return _dated(invoices, columns).groupBy("vendor", cadence.ordinal(F.col("day")).alias("period")).agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        (F.count("invoice") > 0).alias("billed"),
        (F.count("vendor") > 0).alias("known"),
    )


def counted_days(invoices: DataFrame, columns: InvoiceColumns = InvoiceColumns()) -> DataFrame:
    """One row per (vendor, day) with any invoice: how many have an id, the extreme ids, which tell a
    single invoice from several without a distinct count, and whether the vendor is ``known``.

    Copies of an invoice on one day count once. Rows of NULL vendors stay.
    """
    return _dated(invoices, columns).distinct().groupBy("vendor", "day").agg(
        F.count("invoice").alias("n"),
        F.min("invoice").alias("lowest"),
        F.max("invoice").alias("highest"),
        (F.count("vendor") > 0).alias("known"),
    )


def with_counters(days: DataFrame, cadence: Cadence) -> DataFrame:
    """One row per (vendor, period) of ``counted_days`` rows that lie together by vendor, with a counter
    for each usual day.

    The rows with all the counters are only made here, out of an aggregate in the order that the windows
    of ``candidates`` need, so they are neither shuffled nor sorted.
    """
    usual = cadence.usual_day(F.col("day"))
    counters = [
        F.sum(F.when(usual == place, F.col("n")).otherwise(0)).alias(name)
        for place, name in enumerate(_counters(cadence), 1)
    ]
    return days.groupBy("vendor", cadence.ordinal(F.col("day")).alias("period")).agg(
        F.min("day").alias("first_day"),
        # Both ids say whether a period was billed, so every cadence reads the same columns. With
        # fewer, the exchange by vendor could not be shared and would run once for each.
        F.coalesce(F.min("lowest") <= F.max("highest"), F.lit(False)).alias("billed"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
        *counters,
    )


def to_cadence(active: DataFrame, cadence: Cadence) -> DataFrame:
    """Roll active periods up to a coarser cadence."""
    return active.groupBy("vendor", cadence.ordinal(F.col("first_day")).alias("period")).agg(
        F.min("first_day").alias("first_day"), F.bool_or("billed").alias("billed")
    )


def _given(as_of: date | str) -> Column:
    return F.lit(as_of if isinstance(as_of, date) else date.fromisoformat(as_of))


def candidates(active: DataFrame, cadence: Cadence, rules: str) -> DataFrame:
    """Periods following ``lookback`` active ones whose invoice came late or not yet: (vendor, period,
    cadence, usual_day, start, end).

    Only the period right after a run of active ones can be missed, so there is no need for a grid of
    every vendor by every period. In a run, the period's number grows as the row's does, so the row
    ``lookback - 1`` before tells whether the run is long enough, and the next active row, if it is
    the candidate, says when the invoice came. One row per vendor and active period takes part.
    """
    documented = rules == "documented"
    back = cadence.lookback - 1
    by_vendor = Window.partitionBy("vendor").orderBy("period")
    run = by_vendor.rowsBetween(-back, 0)
    columns = {
        "run_start": F.lag("period", back).over(by_vendor) if back else F.col("period"),
        "run_billed": F.min("billed").over(run),
        "next_period": F.lead("period").over(by_vendor),
        "next_day": F.lead("first_day").over(by_vendor),
    }
    if documented:
        counters = _counters(cadence)
        if cadence.unit == "month" and cadence.length > 1:  # such vendors send exactly one
            single = F.col("lowest") == F.col("highest")
            columns["run_billed"] = F.min(F.col("billed") & single).over(run)
        # The most frequent day, the earliest of several.
        most = F.greatest(*[F.col(f"run_{name}") for name in counters]) if len(counters) > 1 else F.col(f"run_{counters[0]}")
        usual = F.coalesce(*[F.when(F.col(f"run_{name}") == most, day) for day, name in enumerate(counters, 1)])
    else:
        first = F.lag("first_day", back).over(by_vendor) if back else F.col("first_day")
        columns["run_first"] = first
        usual = cadence.usual_day(F.col("run_first"))
    runs = active.withColumns(columns)
    ends_run = (F.col("run_start") == F.col("period") - back) & F.col("run_billed")
    if documented:
        # All counters are added up over the rows of such runs alone. No row within one is dropped.
        runs = runs.withColumn("ends_run", F.coalesce(ends_run, F.lit(False)))
        runs = runs.withColumn("in_run", F.bool_or("ends_run").over(by_vendor.rowsBetween(0, back))).where("in_run")
        runs = runs.withColumns({f"run_{name}": F.sum(name).over(run) for name in counters})
        ends_run = F.col("ends_run")
    runs = runs.where(ends_run)
    arrived = F.when(F.col("next_period") == F.col("period") + 1, F.col("next_day"))
    due = runs.select(
        "vendor",
        (F.col("period") + 1).alias("period"),
        cadence.start(F.col("period") + 1).alias("cadence"),
        usual.alias("usual_day"),
        arrived.alias("arrived"),
    )
    end = F.coalesce("arrived", cadence.deadline(F.col("cadence")))
    if documented:
        end = F.least(end, cadence.deadline(F.col("cadence")))
    return due.select(
        "vendor",
        "period",
        "cadence",
        "usual_day",
        cadence.place(F.col("cadence"), F.col("usual_day"), documented).alias("start"),
        end.alias("end"),
    ).where(F.col("end") > F.col("start"))


def _require(invoices: DataFrame, columns: InvoiceColumns, who: str) -> None:
    require_types(
        invoices,
        {columns.vendor: ID_LIKE, columns.invoice: ID_LIKE, columns.date: DATE_LIKE},
        who,
    )


class _Activity:
    """The active periods of a table, or its active days where ``rules`` need those, counted once for
    all cadences of months, and its newest date."""

    def __init__(self, invoices: DataFrame, as_of: date | str | None, rules: str, columns: InvoiceColumns):
        if as_of:
            invoices = invoices.where(F.to_date(columns.date) <= _given(as_of))
        self.invoices, self.columns = invoices, columns
        self.days = counted_days(invoices, columns) if rules == "documented" else None
        self.as_of = as_of
        self.counted: dict[Cadence, DataFrame] = {}

    def _of_base(self, base: Cadence) -> DataFrame:
        if base not in self.counted:
            self.counted[base] = active_periods(self.invoices, base, columns=self.columns)
        return self.counted[base]

    def newest(self, base: Cadence) -> Column:
        """``as_of``, or the newest invoice date of the table, NULL vendors included.

        A scalar subquery over the same aggregate as the periods or days themselves. Spark runs an
        exchange once if both sides need the same columns of it, so this carries every measure along,
        and ``of`` reads ``last_day`` in a comparison that never fails.
        """
        if self.as_of:
            return _given(self.as_of)
        active, day = (self._of_base(base), "last_day") if self.days is None else (self.days, "day")
        others = [name for name in active.columns if name not in ("vendor", "period", day)]
        return active.agg(F.max(F.struct(day, *others))[day]).scalar()

    def of(self, cadence: Cadence) -> DataFrame:
        """Active periods of known vendors, together by vendor.

        One exchange by vendor serves all cadences and their windows. It comes after the
        aggregation, so a vendor contributes at most one row per period, or day, to it.
        """
        if self.days is not None:
            # By bytes, adaptive execution would merge these small rows into fewer tasks than there are
            # cores, and the counters take far longer than the reading. A given number is kept.
            tasks = int(self.days.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            return with_counters(self.days.where("known").drop("known").repartition(tasks, "vendor"), cadence)
        base = _base(cadence)
        active = self._of_base(base).where(F.col("known") & (F.col("first_day") <= F.col("last_day")))
        active = active.drop("known", "last_day").repartition("vendor")
        return active if base == cadence or (base.unit, base.length) == (cadence.unit, cadence.length) else to_cadence(active, cadence)

    def misses(self, cadence: Cadence, rules: str) -> DataFrame:
        found = candidates(self.of(cadence), cadence, rules)
        return found.where(F.col("period") <= cadence.ordinal(self.newest(_base(cadence)))).drop("period")


def cadence_misses(
    invoices: DataFrame,
    cadence: Cadence | str | Mapping,
    *,
    as_of: date | str | None = None,
    rules: str = "code",
    columns: InvoiceColumns = InvoiceColumns(),
) -> DataFrame:
    """(vendor, cadence, usual_day, start, end) for periods missed after ``lookback`` active ones.

    ``cadence`` is the first day of the period, ``start`` the usual day in it. ``end`` is the day the
    invoice came, or else the end of the period's first month, or of its weeks.
    """
    require_rules(rules)
    _require(invoices, columns, "cadence_misses")
    return _Activity(invoices, as_of, rules, columns).misses(Cadence.of(cadence), rules)


def monthly_misses(invoices: DataFrame, **options) -> DataFrame:
    """Months missed after three active ones; see ``cadence_misses``."""
    return cadence_misses(invoices, "month", **options)


def quarterly_misses(invoices: DataFrame, **options) -> DataFrame:
    """Quarters missed after two active ones, whether or not a month in them was missed too."""
    return cadence_misses(invoices, "quarter", **options)


def without_monthly(quarterly: DataFrame, monthly: DataFrame) -> DataFrame:
    """Quarterly misses of vendors with no monthly miss in the same quarter."""
    covered = monthly.select(
        "vendor", cadence_start(F.col("cadence"), "quarter").alias("cadence")
    ).distinct()
    return quarterly.join(covered, ["vendor", "cadence"], "left_anti")


def either_cadence(monthly: DataFrame, quarterly: DataFrame) -> DataFrame:
    """Monthly misses, and the quarterly ones of quarters without any monthly miss.

    Same rows as ``monthly`` united with ``without_monthly``, but each input is computed once.
    """
    return finest_misses([(CADENCES["month"], monthly), (CADENCES["quarter"], quarterly)])


def finest_misses(found: Sequence[tuple[Cadence, DataFrame]]) -> DataFrame:
    """The misses of several cadences, given finest first: one is left out where a finer cadence was
    missed in the same period. A vendor's period holds a few misses of each finer cadence."""
    (_, kept), *coarser = found
    for cadence, misses in coarser:
        both = kept.withColumn("finer", F.lit(True)).unionByName(misses.withColumn("finer", F.lit(False)))
        same = Window.partitionBy("vendor", cadence.ordinal(F.col("cadence")))
        kept = (
            both.withColumn("covered", F.bool_or("finer").over(same))
            .where(F.col("finer") | ~F.col("covered"))
            .drop("finer", "covered")
        )
    return kept


def daily(misses: DataFrame) -> DataFrame:
    """One row per day from ``start`` up to, but not including, ``end``."""
    days = F.when(
        F.col("end") > F.col("start"), F.sequence("start", F.date_sub("end", 1))
    )
    return misses.withColumn("date", F.explode(days))


def missing_invoices(
    invoices: DataFrame,
    *,
    as_of: date | str | None = None,
    rules: str = "code",
    cadences: Sequence[Cadence | str | Mapping] = ("month", "quarter"),
    columns: InvoiceColumns = InvoiceColumns(),
) -> DataFrame:
    """One alert per vendor and day on which an expected invoice is outstanding.

    ``as_of`` (a date, or its ISO text) sets the current date and hides later invoices; no alert
    is dated after it. By default the newest invoice date in the table is current, and alerts go
    to the end of its cadence. ``cadences`` are looked at from the finest to the coarsest.
    """
    require_rules(rules)
    _require(invoices, columns, "missing_invoices")
    chosen = sorted(map(Cadence.of, cadences), key=lambda c: c.days)
    if not chosen:
        raise ValueError("name one cadence at least")
    activity = _Activity(invoices, as_of, rules, columns)
    misses = finest_misses(
        [(c, activity.misses(c, rules).withColumn("unit", F.lit(c.unit))) for c in chosen]
    )
    return missing_alerts(misses, as_of=as_of, rules=rules)


def missing_alerts(misses: DataFrame, *, as_of: date | str | None = None, rules: str = "code") -> DataFrame:
    """The alerts of misses, a row for each day; ``unit`` names the cadence's unit."""
    if as_of:
        misses = misses.withColumn("end", F.least("end", F.date_add(_given(as_of), 1)))
    return daily(misses).select(
        F.col("vendor").alias("canonical_vendor_id"),
        F.col("date").alias("insight_date"),
        sentence(
            "missing",
            rules,
            vendor=F.col("vendor"),
            day=F.col("usual_day").cast("string"),
            unit=F.col("unit"),
            date=F.col("date").cast("string"),
        ).alias("insight_text"),
    )
