"""From detector output to the alert table: ids, names, types, and the combined table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from enum import IntEnum
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.schema import ALERT_SCHEMA


class AlertType(IntEnum):
    """The ``glean_type`` codes; the names are the keys used in configurations."""

    VendorNotSeenInAWhile = 1
    AccrualAlert = 2
    LargeMonthIncreaseMtd = 3
    NoInvoiceReceived = 4


class AlertLocation(IntEnum):
    """The ``glean_location`` codes."""

    Invoice = 1
    Vendor = 2


# The documented names of the codes above.
TYPE_NAMES = {
    1: "vendor_not_seen_in_a_while",
    2: "accrual_alert",
    3: "large_month_increase_mtd",
    4: "no_invoice_received",
}
LOCATION_NAMES = {1: "invoice", 2: "vendor"}

_SEPARATOR = "\x1f"
_ABSENT = "\x1e"


def alert_id(parts: list[Column]) -> Column:
    """UUID-shaped id derived from the alert's content.

    The same alert has the same id in every run and after a task is retried; NULL parts are
    marked, so that they differ from empty ones.
    """
    marked = [F.coalesce(part.cast("string"), F.lit(_ABSENT)) for part in parts]
    digest = F.md5(F.concat_ws(_SEPARATOR, *marked))
    groups = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in groups])


def conform(
    insights: DataFrame,
    alert_type: int,
    location: int,
    *,
    ids: str = "content",
) -> DataFrame:
    """Bring a detector's rows into ``ALERT_SCHEMA``.

    The detector supplies ``insight_date``, ``insight_text``, ``canonical_vendor_id`` and, for
    invoice-level alerts, ``invoice_id``; ``insight_key`` is an optional extra part of the id.
    ``ids="random"`` draws a random UUID per row instead; those change when a task is retried.
    """
    required = {"insight_date", "insight_text", "canonical_vendor_id"}
    if location == AlertLocation.Invoice:
        required.add("invoice_id")
    missing = sorted(required - set(insights.columns))
    if missing:
        raise ValueError(f"detector output lacks: {', '.join(missing)}")
    if ids not in ("content", "random"):
        raise ValueError(f"ids must be 'content' or 'random', not {ids!r}")
    optional = {
        name: F.col(name) if name in insights.columns else F.lit(None).cast("string")
        for name in ("invoice_id", "insight_key")
    }
    key = [
        F.lit(int(alert_type)),
        F.col("canonical_vendor_id"),
        optional["invoice_id"],
        F.col("insight_date"),
        F.col("insight_text"),
    ]
    if "insight_key" in insights.columns:
        key.append(F.date_format("insight_key", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    values = {
        "glean_id": alert_id(key) if ids == "content" else F.uuid(),
        "glean_date": F.col("insight_date"),
        "glean_text": F.col("insight_text"),
        "glean_type": F.lit(int(alert_type)),
        "glean_location": F.lit(int(location)),
        "invoice_id": optional["invoice_id"],
        "canonical_vendor_id": F.col("canonical_vendor_id"),
    }
    return insights.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in ALERT_SCHEMA]
    )


def combine(alerts: Iterable[DataFrame], spark: SparkSession | None = None) -> DataFrame:
    """Union alert tables by name, filling absent columns; no alert tables give an empty table."""
    frames = list(alerts)
    if not frames:
        session = spark or SparkSession.active()
        return session.createDataFrame([], ALERT_SCHEMA)
    union = reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), frames
    )
    return union.select(*ALERT_SCHEMA.names)


def with_names(alerts: DataFrame, types: Mapping[int, str] = TYPE_NAMES) -> DataFrame:
    """Replace the type and location codes by their names; ``types`` has those of the types."""

    def named(code: str, names: Mapping[int, str]) -> Column:
        pairs = [F.lit(item) for pair in names.items() for item in pair]
        return F.try_element_at(F.create_map(*pairs), F.col(code))

    return alerts.withColumns(
        {
            "glean_type": named("glean_type", types),
            "glean_location": named("glean_location", LOCATION_NAMES),
        }
    )
