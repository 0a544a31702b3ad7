"""Alerts kept up to date batch by batch, with late and corrected invoices, without a new full run.

A state folder holds what the detectors need of all rows seen: rows by vendor and by invoice id, the
active days and months of each vendor, and the alerts' own rows. A batch adds its rows, works out
again the days and months it touches, adds what it changes to the months' totals, and replaces the
results of its vendors and invoices. Tables lie in buckets by a hash of vendor or invoice id; the
buckets that a batch does not touch are neither read nor written. A batch that is large against what
its buckets hold (see ``FEW``) has them worked out anew, in two exchanges of their rows: to find out
what it changes would take ten and sorted joins. The new state becomes visible all at once (see
``sources.versions``), so a batch that fails can simply be applied again.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.dates import CADENCES, Cadence
from ledgerlark.functions.money import exact_amount
from ledgerlark.operators.accrual import accrual_of
from ledgerlark.operators.alerts import AlertLocation, AlertType, combine, conform
from ledgerlark.operators.cadence import candidates, finest_misses, missing_alerts, to_cadence
from ledgerlark.operators.dormant import dormant_from_days
from ledgerlark.operators.invoices import INVOICE_KEY, keyed_by_invoice, vendor_days
from ledgerlark.operators.spend import history_of_months, large_from_history
from ledgerlark.schema import MONEY, InvoiceColumns
from ledgerlark.sources.versions import VersionedFolder

MONTH, QUARTER = CADENCES["month"], CADENCES["quarter"]
SUM = "decimal(34,6)"
_OPENING = "struct<issued:timestamp,invoice:string>"
_MISS = "vendor string, period int, cadence date, usual_day int, start date, end date"

#: The tables of a state. Those of rows only grow, and are merged as they are read: by the largest
#: amount, the latest end. The others are replaced bucket by bucket.
ROWS = {
    "rows": f"vendor string, invoice string, issued timestamp, amount {MONEY.simpleString()}",
    "dates": "vendor string, invoice string, issued timestamp",
    "ends": "invoice string, period_end timestamp",
}
REPLACED = {
    "days": f"vendor string, day date, opening {_OPENING}, closing timestamp",
    "months": f"vendor string, period int, spend {SUM}, priced bigint, first_day date, billed boolean",
    "month_misses": _MISS,
    "quarter_misses": _MISS,
    "dormant": "vendor string, canonical_vendor_id string, invoice_id string, insight_date date, insight_text string",
    "large": "vendor string, canonical_vendor_id string, insight_date date, insight_text string",
    "accrual": "vendor string, invoice string, issued timestamp, period_end timestamp",
}
BY_INVOICE = {"dates", "ends", "accrual"}
#: A batch whose buckets hold more than this many times its rows is looked up in them.
FEW = 8


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi or anti join on keys, where NULLs are equal."""
    other = right.select(*[F.col(key).alias(f"other_{key}") for key in keys])
    on = reduce(and_, [F.col(key).eqNullSafe(F.col(f"other_{key}")) for key in keys])
    return left.join(other, on, how)


class SignalState:
    """The state in ``root``; made by the first batch. ``buckets`` and ``window`` are fixed then."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        *,
        buckets: int = 64,
        window: int = 90,
        columns: InvoiceColumns = InvoiceColumns(),
    ):
        self.spark, self.columns = spark, columns
        self.folder = VersionedFolder(spark, root)
        self.version, self.content = self.folder.current()
        if not self.content:
            self.content = {"buckets": buckets, "window": window, "newest": None, "tables": {}}
        self.buckets, self.window = self.content["buckets"], self.content["window"]

    # --- tables ----------------------------------------------------------------------------------

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def table(self, name: str, buckets: list[int] | None = None) -> DataFrame:
        """A table of the state, all of it or some buckets. Rows are as stored, not merged."""
        held = self.content["tables"].get(name, {})
        chosen = held if buckets is None else [str(b) for b in buckets if str(b) in held]
        paths = [path for b in chosen for path in held[b]]
        schema = T.StructType.fromDDL((ROWS | REPLACED)[name])
        return self._read(schema, paths)

    def _read(self, schema: T.StructType, paths: list[str]) -> DataFrame:
        if paths:
            return self.spark.read.schema(schema).parquet(*paths)
        # Seen to be empty as the plan is built, so that joins with it fall away.
        absent = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema]
        return self.spark.range(1).where(F.lit(False)).select(*absent)

    def _write(self, part: str, name: str, rows: DataFrame, key: str, touched: list[int] | None) -> list[int]:
        """Add rows, or put them in the place of the ``touched`` buckets; returns the buckets written."""
        path = f"{part}/{name}"
        schema = T.StructType.fromDDL((ROWS | REPLACED)[name])
        chosen = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        # Large buckets are split over tasks, small ones share one.
        dealt = chosen.withColumn("bucket", self._bucket(key)).hint("rebalance", "bucket")
        dealt.write.partitionBy("bucket").parquet(path)
        held = dict(self.content["tables"].get(name, {}))
        for bucket in touched or ():
            held.pop(str(bucket), None)
        written = [folder.removeprefix("bucket=") for folder in self.folder.subfolders(path)]
        for bucket in written:
            held[bucket] = [*held.get(bucket, []), f"{path}/bucket={bucket}"]
        self.content = self.content | {"tables": self.content["tables"] | {name: held}}
        return [int(bucket) for bucket in written]

    # --- batches ---------------------------------------------------------------------------------

    def apply(self, invoices: DataFrame, line_items: DataFrame | None = None) -> int:
        """Add a batch; returns the number of the new version. Rows may come late, again, or with other
        dates and amounts: alerts are then those of one run over all rows of all batches."""
        before = self.content
        try:
            part = self.folder.new_part()
            self._apply(part, invoices, line_items)
            self.version = self.folder.publish(self.version, self.content)
        except BaseException:
            self.content = before
            raise
        return self.version

    def _apply(self, part: str, invoices: DataFrame, line_items: DataFrame | None) -> None:
        c = self.columns
        amount = exact_amount(F.col(c.amount), invoices.schema[c.amount].dataType)
        batch = invoices.groupBy(
            F.col(c.vendor).alias("vendor"), F.col(c.invoice).alias("invoice"), F.col(c.date).cast("timestamp").alias("issued")
        ).agg(F.max(amount).alias("amount"))
        earlier = self.content["tables"].get("rows", {})
        touched = self._write(part, "rows", batch, "vendor", None)
        batch = self._added("rows", earlier)
        rows = self.table("rows", touched)  # the batch included
        old = self._held("rows", earlier, touched)
        size, newest = batch.agg(F.count(F.lit(1)), F.max(F.to_date("issued")).cast("string")).first()
        few = FEW * size < old.count()
        days = self._days(batch, old, rows, touched) if few else self._all_days(rows)
        self._write(part, "days", days, "vendor", touched)
        alone = not any(str(bucket) in earlier for bucket in touched)
        months = self._months(batch, old, touched) if few else self._all_months(rows, merged=alone)
        self._write(part, "months", months, "vendor", touched)
        self._results(part, batch.select("vendor").distinct() if few else None, touched)
        self._accruals(part, batch, line_items)
        known = [day for day in (self.content["newest"], newest) if day]
        self.content = self.content | {"newest": max(known, default=None)}

    def _added(self, name: str, earlier: dict) -> DataFrame:
        """The rows just written, read back."""
        now = self.content["tables"][name]
        paths = [path for b, held in now.items() for path in held if path not in earlier.get(b, [])]
        return self._read(T.StructType.fromDDL(ROWS[name]), paths)

    def _held(self, name: str, earlier: dict, touched: list[int]) -> DataFrame:
        """The rows that the touched buckets held before."""
        paths = [path for b in touched for path in earlier.get(str(b), [])]
        return self._read(T.StructType.fromDDL(ROWS[name]), paths)

    def _all_days(self, rows: DataFrame) -> DataFrame:
        """Active days of all ``rows``."""
        return vendor_days(rows.groupBy("vendor", "invoice").agg(F.max("issued").alias("issued")))

    def _all_months(self, rows: DataFrame, merged: bool) -> DataFrame:
        """Active months of all ``rows``; ``merged`` if no two are of one invoice and date, as in a single batch."""
        dated = rows.where(F.col("issued").isNotNull())
        if not merged:
            dated = dated.groupBy("vendor", "invoice", "issued").agg(F.max("amount").alias("amount"))
        zero = F.lit(0).cast(MONEY)
        return (
            dated
            .groupBy("vendor", MONTH.ordinal(F.to_date("issued")).alias("period"))
            .agg(
                F.sum(F.coalesce("amount", zero)).cast(SUM).alias("spend"),
                F.count("amount").alias("priced"),
                F.min(F.to_date("issued")).alias("first_day"),
                (F.count("invoice") > 0).alias("billed"),
            )
        )

    def _days(self, batch: DataFrame, old: DataFrame, rows: DataFrame, touched: list[int]) -> DataFrame:
        """Active days, those anew on which an invoice of the batch lay or lies."""
        id = ["vendor", "invoice"]

        def latest(df: DataFrame) -> DataFrame:
            return df.groupBy(*id).agg(F.max("issued").alias("issued"))

        mine = _same(old, batch.select(*id).distinct(), id, "left_semi")
        day = F.to_date("issued").alias("day")
        moved = latest(mine).select("vendor", day).unionByName(latest(mine.unionByName(batch)).select("vendor", day))
        moved = moved.where(F.col("day").isNotNull()).distinct()
        # All invoices seen on those days, then the latest date of each over all its rows.
        on_days = _same(rows.withColumn("day", F.to_date("issued")), moved, ["vendor", "day"], "left_semi")
        whole = latest(_same(rows, on_days.select(*id).distinct(), id, "left_semi"))
        anew = _same(vendor_days(whole), moved, ["vendor", "day"], "left_semi")
        return _same(self.table("days", touched), moved, ["vendor", "day"], "left_anti").unionByName(anew)

    def _months(self, batch: DataFrame, old: DataFrame, touched: list[int]) -> DataFrame:
        """Active months: the batch's own days and amounts, less what its invoices counted before."""
        grain = ["vendor", "invoice", "issued"]
        mine = _same(old, batch.select(*grain), grain, "left_semi").withColumn("new", F.lit(False))
        both = mine.unionByName(batch.withColumn("new", F.lit(True)))
        changes = both.where(F.col("issued").isNotNull()).groupBy(*grain).agg(
            F.max("amount").alias("now"), F.max(F.when(~F.col("new"), F.col("amount"))).alias("before")
        )
        zero = F.lit(0).cast(MONEY)
        added = changes.groupBy("vendor", MONTH.ordinal(F.to_date("issued")).alias("period")).agg(
            F.sum(F.coalesce("now", zero) - F.coalesce("before", zero)).cast(SUM).alias("spend"),
            F.sum(F.col("now").isNotNull().cast("int") - F.col("before").isNotNull().cast("int")).alias("priced"),
            F.min(F.to_date("issued")).alias("first_day"),
            (F.count("invoice") > 0).alias("billed"),
        )
        return (
            self.table("months", touched)
            .unionByName(added)
            .groupBy("vendor", "period")
            .agg(
                F.sum("spend").cast(SUM).alias("spend"),
                F.sum("priced").alias("priced"),
                F.min("first_day").alias("first_day"),
                F.bool_or("billed").alias("billed"),
            )
        )

    def _results(self, part: str, vendors: DataFrame | None, touched: list[int]) -> None:
        """Alerts and misses of the batch's vendors, or of all in their buckets, from days and months."""

        def of_vendors(name: str) -> DataFrame:
            held = self.table(name, touched)
            return held if vendors is None else _same(held, vendors, ["vendor"], "left_semi")

        def replace(name: str, found: DataFrame) -> None:
            if vendors is not None:
                kept = _same(self.table(name, touched), vendors, ["vendor"], "left_anti")
                found = kept.unionByName(found)
            self._write(part, name, found, "vendor", touched)

        keyed = F.col("canonical_vendor_id").alias("vendor")
        dormant = dormant_from_days(of_vendors("days"), window=self.window)
        replace("dormant", dormant.select(keyed, "*"))
        months = of_vendors("months")
        spend = F.when(F.col("priced") > 0, F.col("spend")).alias("spend")
        monthly = months.select("vendor", MONTH.start(F.col("period")).alias("month"), spend)
        large = large_from_history(history_of_months(monthly))
        replace("large", large.select(keyed, "*"))
        active = months.where(F.col("vendor").isNotNull()).select("vendor", "period", "first_day", "billed")
        active = active.repartition("vendor")
        for cadence, name in ((MONTH, "month_misses"), (QUARTER, "quarter_misses")):
            periods = active if cadence is MONTH else to_cadence(active, cadence)
            # Those of periods still to come are kept too: they count once the newest date gets there.
            replace(name, candidates(periods, cadence, "code"))

    def _accruals(self, part: str, batch: DataFrame, line_items: DataFrame | None) -> None:
        c = self.columns
        parts = {"dates": batch.select("vendor", "invoice", "issued")}
        if line_items is not None:
            parts["ends"] = line_items.groupBy(F.col(c.invoice).alias("invoice")).agg(
                F.max(F.col(c.period_end).cast("timestamp")).alias("period_end")
            )
        earlier = {name: self.content["tables"].get(name, {}) for name in parts}
        written = [
            self._write(part, name, rows.where(F.col("invoice").isNotNull()), "invoice", None)
            for name, rows in parts.items()
        ]
        touched = sorted(set().union(*written))
        added = [self._added(name, earlier[name]) for name in parts]
        held = [self._held(name, before, touched) for name, before in earlier.items()]
        few = FEW * sum(df.count() for df in added) < sum(df.count() for df in held)
        ids = reduce(DataFrame.unionByName, [df.select("invoice") for df in added]).distinct()

        def of_ids(name: str) -> DataFrame:
            held = self.table(name, touched)
            return _same(held, ids, ["invoice"], "left_semi") if few else held

        # Every batch has at most one end of an id, and one row of a date: the latest of those that
        # are late is found after the join, in which their copies have come together.
        found = keyed_by_invoice(of_ids("dates")).join(keyed_by_invoice(of_ids("ends")), INVOICE_KEY)
        late = (
            found.where(F.col("period_end") > F.date_add("issued", self.window))
            .groupBy("vendor", "invoice", "issued")
            .agg(F.max("period_end").alias("period_end"))
        )
        if few:
            late = _same(self.table("accrual", touched), ids, ["invoice"], "left_anti").unionByName(late)
        self._write(part, "accrual", late, "invoice", touched)

    # --- reading ---------------------------------------------------------------------------------

    def insights(self) -> dict[AlertType, DataFrame]:
        """Each detector's rows, as its function gives them over all batches."""
        newest = F.to_date(F.lit(self.content["newest"]))

        def misses(cadence: Cadence, name: str) -> DataFrame:
            due = self.table(name).where(F.col("period") <= cadence.ordinal(newest))
            return due.drop("period").withColumn("unit", F.lit(cadence.unit))

        found = finest_misses([(MONTH, misses(MONTH, "month_misses")), (QUARTER, misses(QUARTER, "quarter_misses"))])
        return {
            AlertType.VendorNotSeenInAWhile: self.table("dormant").drop("vendor"),
            AlertType.AccrualAlert: accrual_of(self.table("accrual")),
            AlertType.LargeMonthIncreaseMtd: self.table("large").drop("vendor"),
            AlertType.NoInvoiceReceived: missing_alerts(found),
        }

    def alerts(self) -> DataFrame:
        """The alert table of all batches so far."""
        level = {AlertType.VendorNotSeenInAWhile: AlertLocation.Invoice, AlertType.AccrualAlert: AlertLocation.Invoice}
        return combine(
            [conform(df, kind, level.get(kind, AlertLocation.Vendor)) for kind, df in self.insights().items()], self.spark
        )

    def compact(self) -> int:
        """Merge the parts of the tables that only grow, and delete what no version uses any more."""
        part, before = self.folder.new_part(), self.content
        every = list(range(self.buckets))
        merged = {
            "rows": ("vendor", self.table("rows").groupBy("vendor", "invoice", "issued").agg(F.max("amount").alias("amount"))),
            "dates": ("invoice", self.table("dates").distinct()),
            "ends": ("invoice", self.table("ends").groupBy("invoice").agg(F.max("period_end").alias("period_end"))),
        }
        try:
            for name, (key, rows) in merged.items():
                self._write(part, name, rows, key, every)
            self.version = self.folder.publish(self.version, self.content)
        except BaseException:
            self.content = before
            raise
        self.folder.prune(set(), keep=1)
        return self.version
