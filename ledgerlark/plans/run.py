"""Running detectors over named tables, or from a configuration, as one lazy plan."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.dates import Cadence
from ledgerlark.functions.money import exact_amount
from ledgerlark.operators.alerts import combine, conform
from ledgerlark.operators.spend import SpendBand
from ledgerlark.plans.registry import SIGNALS, with_names
from ledgerlark.schema import SPEC_LISTS, InvoiceColumns, TableSpec
from ledgerlark.sources.sinks import read_alerts, write_alerts
from ledgerlark.sources.tables import checkpoint_folder, read_typed, stage


def run_signals(
    tables: Mapping[str, DataFrame],
    signals: Mapping[str, Mapping[str, Any]],
    *,
    rules: str = "code",
    ids: str = "content",
    shared: bool = False,
) -> DataFrame:
    """Run detectors and combine their alerts. Nothing is executed until the result is used.

    With ``shared``, an invoice table that several detectors read is first reduced to one row per
    (vendor, invoice, date) and staged, at once, so that its source is read and copies are combined
    only once; see ``shared_invoices``.

    ``signals`` maps detector names to arguments; arguments that take a table give its name in
    ``tables``, all others (such as ``window``) are passed on; ``columns``, each of ``bands`` and each
    of ``cadences`` may be a mapping, as a configuration has it.
    """
    unknown = sorted(set(signals) - set(SIGNALS))
    if unknown:
        raise ValueError(f"unknown detectors: {', '.join(unknown)}")
    alerts = []
    if shared:
        tables = _with_shared(tables, signals)
    for name, arguments in signals.items():
        signal = SIGNALS[name]
        absent = sorted(set(signal.tables) - set(arguments))
        if absent:
            raise ValueError(f"{name} needs: {', '.join(absent)}")
        call: dict[str, Any] = {"rules": rules} if signal.takes_rules else {}
        for argument, value in arguments.items():
            if argument not in signal.tables:
                call[argument] = _typed(argument, value)
            elif value in tables:
                call[signal.tables[argument]] = tables[value]
            else:
                raise ValueError(f"{name}: no table named {value!r}")
        alerts.append(conform(signal.detect(**call), signal.alert_type, signal.location, ids=ids))
    return combine(alerts)


def shared_invoices(invoices: DataFrame, columns: InvoiceColumns = InvoiceColumns()) -> DataFrame:
    """One row per (vendor, invoice, date) with the largest amount and the latest period end, staged.

    Every detector gives the same alerts for it as for ``invoices``: all of them reduce copies in this
    way, or further. The staged table goes when the application ends, or by ``scratch.release``.
    """
    measures = []
    if columns.amount in invoices.columns:
        kind = invoices.schema[columns.amount].dataType
        measures.append(F.max(exact_amount(F.col(columns.amount), kind)).alias(columns.amount))
    if columns.period_end in invoices.columns:
        measures.append(F.max(columns.period_end).alias(columns.period_end))
    keys = [columns.vendor, columns.invoice, columns.date]
    return stage(invoices.groupBy(*keys).agg(*measures) if measures else invoices.select(*keys).distinct())


def _with_shared(
    tables: Mapping[str, DataFrame], signals: Mapping[str, Mapping[str, Any]]
) -> Mapping[str, DataFrame]:
    """Tables with those replaced that several built-in detectors, and no others, read as invoices
    under the same column names."""
    readers: dict[str, list] = {}
    for name, arguments in signals.items():
        signal = SIGNALS.get(name)
        for argument, role in (signal.tables if signal else {}).items():
            plain = signal.reduces_copies and role == "invoices"
            readers.setdefault(arguments.get(argument), []).append(
                _typed("columns", arguments.get("columns", InvoiceColumns())) if plain else None
            )
    replaced = {
        table: shared_invoices(tables[table], columns[0])
        for table, columns in readers.items()
        if table in tables and len(columns) > 1 and columns[0] is not None and len(set(columns)) == 1
    }
    return {**tables, **replaced}


def _typed(argument: str, value: Any) -> Any:
    """An argument as a configuration has it, in the type that detectors take."""
    if argument == "columns" and isinstance(value, Mapping):
        return InvoiceColumns(**value)
    if argument == "bands" and value is not None:
        return tuple(SpendBand(**band) if isinstance(band, Mapping) else band for band in value)
    if argument == "cadences":
        return [Cadence.of(cadence) for cadence in value]
    return value


def load_tables(
    spark: SparkSession, data: Mapping[str, Mapping[str, Any]], **options
) -> dict[str, DataFrame]:
    """Load every table of a configuration's ``Data`` section."""
    tables = {}
    for name, entry in data.items():
        spec = TableSpec(**{key: tuple(entry.get(key, ())) for key in SPEC_LISTS})
        tables[name] = read_typed(
            spark, entry["file_path"], spec, format=entry.get("format", "csv"), **options
        )
    return tables


def run_config(
    spark: SparkSession,
    config: Mapping[str, Any],
    *,
    rules: str = "code",
    ids: str = "content",
    on_bad_value: str = "null",
    staged: bool = False,
    shared: bool = False,
) -> DataFrame:
    """Build the alert table a configuration describes (``Data``, ``Gleans``, ``OutputPath``).

    ``staged=True`` first converts CSV sources to parquet in the shared checkpoint folder, so
    that they are parsed once and not once per detector. That part runs at once; all else is
    lazy. ``shared=True`` does the same for invoices reduced to one row for each (see ``run_signals``).
    """
    _require_sections(config)
    tables = load_tables(spark, config["Data"], on_bad_value=on_bad_value)
    if staged:
        for name, entry in config["Data"].items():
            if entry.get("format", "csv") == "csv":
                tables[name] = stage(tables[name])
    return run_signals(tables, config["Gleans"], rules=rules, ids=ids, shared=shared)


def execute_config(spark: SparkSession, config: Mapping[str, Any], **options) -> DataFrame:
    """Run a configuration, write its alerts to ``OutputPath`` and return them as written.

    CSV sources are staged (see ``run_config``) wherever the session names a checkpoint folder.
    By ``rules="documented"``, types and locations are written by name. ``"OutputVersioned": true``
    keeps the output before it readable until the new one is whole (see ``write_alerts``).
    """
    _require_sections(config)
    options.setdefault("staged", checkpoint_folder(spark) is not None)
    output_format = config.get("OutputFormat", "csv")
    alerts = run_config(spark, config, **options)
    named = options.get("rules") == "documented"
    write_alerts(
        with_names(alerts) if named else alerts,
        config["OutputPath"],
        output_format,
        versioned=bool(config.get("OutputVersioned", False)),
    )
    return read_alerts(spark, config["OutputPath"], output_format, named=named)


def _require_sections(config: Mapping[str, Any]) -> None:
    absent = [name for name in ("Data", "Gleans", "OutputPath") if name not in config]
    if absent:
        raise ValueError(f"configuration lacks: {', '.join(absent)}")
    for section in ("Data", "Gleans"):
        entries = config[section]
        if not isinstance(entries, Mapping) or not all(
            isinstance(entry, Mapping) for entry in entries.values()
        ):
            raise ValueError(f"{section} must map names to settings")
