from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import ledgerlark as ll
from ledgerlark.operators.alerts import with_names
from ledgerlark.schema import ALERT_SCHEMA, TableSpec, require_types
from ledgerlark.sources.sinks import read_alerts, write_alerts
from ledgerlark.sources.scratch import release, run_folder
from tests.helpers import found, invoices

SPEC = ll.TableSpec(
    string_columns=("invoice_id",),
    float_columns=("total_amount",),
    integer_columns=("lines",),
    datetime_columns=("invoice_date",),
)
GOOD = "extra,invoice_date,invoice_id,lines,total_amount\nx,2020-01-31 10:00:00,00123,4,10.10\n"


def written(folder, *contents):
    for n, content in enumerate(contents):
        (folder / f"part-{n}.csv").write_text(content)
    return str(folder)


def test_declared_types_and_order(spark, tmp_path):
    df = ll.read_typed(spark, written(tmp_path, GOOD), SPEC)
    assert df.columns == ["invoice_id", "total_amount", "lines", "invoice_date"]
    assert [f.dataType for f in df.schema] == [
        T.StringType(),
        T.DecimalType(24, 6),
        T.IntegerType(),
        T.TimestampType(),
    ]
    assert [tuple(row) for row in df.collect()] == [
        ("00123", Decimal("10.10"), 4, datetime(2020, 1, 31, 10))
    ]


def test_bad_values_become_null_or_fail(spark, tmp_path):
    path = written(
        tmp_path, GOOD + "x,yesterday,a,many,lots\nx,,,,\nx,2020-01-31,b,1,2.345\n"
    )
    rows = found(ll.read_typed(spark, path, SPEC), *SPEC.names)
    assert rows == [
        (None, None, None, None),
        ("00123", Decimal("10.10"), 4, datetime(2020, 1, 31, 10)),
        ("a", None, None, None),
        ("b", Decimal("2.345"), 1, datetime(2020, 1, 31)),
    ]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ll.read_typed(spark, path, SPEC, on_bad_value="fail").collect()
    with pytest.raises(ValueError, match="on_bad_value"):
        ll.read_typed(spark, path, SPEC, on_bad_value="ignore")


def test_missing_and_repeated_columns(spark, tmp_path):
    path = written(tmp_path, "invoice_id,total_amount\na,1\n")
    with pytest.raises(ValueError, match="invoice_date, lines"):
        ll.read_typed(spark, path, SPEC)
    with pytest.raises(ValueError, match="more than once: a"):
        ll.TableSpec(string_columns=("a", "b"), float_columns=("a",))
    with pytest.raises(ValueError, match="at least one"):
        ll.TableSpec()


def test_every_file_must_have_the_same_header(spark, tmp_path):
    other = "invoice_date,extra,invoice_id,lines,total_amount\n2020-01-31,x,a,4,10.10\n"
    path = written(tmp_path, GOOD, other)
    with pytest.raises(Exception, match="header"):
        ll.read_typed(spark, path, SPEC).collect()


def test_given_header_needs_no_look_at_the_file(spark, tmp_path):
    path = written(tmp_path, GOOD)
    spark.sparkContext.setJobGroup("given-header", "")
    header = ["extra", "invoice_date", "invoice_id", "lines", "total_amount"]
    df = ll.read_typed(spark, path, SPEC, header=header)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("given-header")
    assert found(df, "invoice_id") == [("00123",)]


def test_single_floats_on_request(spark, tmp_path):
    spec = ll.TableSpec(float_columns=("total_amount",), float_type=T.FloatType())
    row = ll.read_typed(spark, written(tmp_path, GOOD), spec).first()
    assert row.total_amount == pytest.approx(10.10, abs=1e-5) and row.total_amount != 10.10


def test_columnar_source(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.sql("SELECT 7 AS invoice_id, 1.5D AS total_amount, 2L AS lines, "
              "DATE'2020-01-31' AS invoice_date, 'x' AS extra").write.parquet(path)
    df = ll.read_typed(spark, path, SPEC, format="parquet")
    assert found(df, *SPEC.names) == [("7", Decimal("1.50"), 2, datetime(2020, 1, 31))]


def test_other_time_zones_are_refused(spark, tmp_path):
    path = written(tmp_path, GOOD)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            ll.read_typed(spark, path, SPEC)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_contract(spark):
    df = spark.sql("SELECT 1 AS a, 'x' AS b")
    require_types(df, {"a": (T.NumericType,), "b": (T.StringType,)}, "test")
    with pytest.raises(TypeError, match="test: a is int; c is missing"):
        require_types(df, {"a": (T.StringType,), "c": (T.StringType,)}, "test")


AWKWARD = 'quote " comma , tick ` and \\ slash'


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_alerts_survive_a_round_trip(spark, tmp_path, format):
    table = invoices(
        spark,
        (AWKWARD, "a", "2020-01-01", "1"),
        (AWKWARD, "b", "2020-06-01", "99999"),
        (None, "c", "2020-01-01", "1"),
        (None, "d", "2020-06-01", "1"),
    )
    settings = {
        "VendorNotSeenInAWhile": {"invoice_data_loader": "inv"},
        "LargeMonthIncreaseMtd": {"invoice_data_loader": "inv"},
    }
    alerts = ll.run_signals({"inv": table}, settings)
    path = str(tmp_path / "alerts")
    for _ in range(2):  # the second write replaces the first
        ll.write_alerts(alerts, path, format)
    back = ll.read_alerts(spark, path, format)
    names = ll.ALERT_SCHEMA.names
    assert back.schema == ll.ALERT_SCHEMA
    assert found(back, *names) == found(alerts, *names) and back.count() == 3
    with pytest.raises(ValueError, match="format"):
        ll.write_alerts(alerts, path, "xml")


def config(tmp_path):
    table = "invoice_id,canonical_vendor_id,invoice_date,total_amount,period_end_date\n"
    table += "a,v,2020-01-01,10,2020-01-31\nb,v,2020-06-01,90000,\n"
    items = "invoice_id,line_item_id,period_end_date\na,1,2020-12-31\n"
    (tmp_path / "inv.csv").write_text(table)
    (tmp_path / "li.csv").write_text(items)
    invoices_only = {"invoice_data_loader": "inv"}
    return {
        "Data": {
            "inv": {
                "file_path": str(tmp_path / "inv.csv"),
                "string_columns": ["invoice_id", "canonical_vendor_id"],
                "datetime_columns": ["invoice_date", "period_end_date"],
                "float_columns": ["total_amount"],
            },
            "li": {
                "file_path": str(tmp_path / "li.csv"),
                "string_columns": ["invoice_id", "line_item_id"],
                "datetime_columns": ["period_end_date"],
            },
        },
        "Gleans": {
            "VendorNotSeenInAWhile": invoices_only,
            "AccrualAlert": {**invoices_only, "line_item_data_loader": "li"},
            "LargeMonthIncreaseMtd": invoices_only,
            "NoInvoiceReceived": invoices_only,
        },
        "OutputPath": str(tmp_path / "out" / "gleans.csv"),
    }


def test_config_run_writes_what_it_returns(spark, tmp_path):
    settings = config(tmp_path)
    result = ll.execute_config(spark, settings)
    assert found(result, "glean_type", "invoice_id") == [(1, "b"), (2, "a"), (3, None)]
    header = next((tmp_path / "out" / "gleans.csv").glob("*.csv")).read_text().splitlines()[0]
    assert header.split(",") == ll.ALERT_SCHEMA.names


def test_staged_config_run_reads_each_source_once(spark, tmp_path, monkeypatch):
    settings = config(tmp_path)
    staged = ll.run_config(spark, settings, staged=True)
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert all(f"{run_folder(spark)}/staged-" in file for file in staged.inputFiles()) and "Format: CSV" not in plan
    names = ll.ALERT_SCHEMA.names
    assert found(staged, *names) == found(ll.run_config(spark, settings), *names)
    monkeypatch.setattr("ledgerlark.sources.tables.checkpoint_folder", lambda spark: None)
    with pytest.raises(ValueError, match="checkpoint"):
        ll.run_config(spark, settings, staged=True)


def test_incomplete_config(spark, tmp_path):
    settings = config(tmp_path)
    del settings["OutputPath"]
    with pytest.raises(ValueError, match="OutputPath"):
        ll.run_config(spark, settings)
    with pytest.raises(ValueError, match="Data must map"):
        ll.run_config(spark, {**config(tmp_path), "Data": ["x"]})


def test_alerts_come_back_as_written(spark, tmp_path):
    texts = [" inv1 ", "a\nb", "a\r\nb", 'q"u"', "", None, "\\", "\\n", "\\\\n", "\\N", ",", "é"]
    rows = [(str(n), date(2020, 1, 1), t, 1, 2, t, t) for n, t in enumerate(texts)]
    alerts = spark.createDataFrame(rows, ALERT_SCHEMA)
    write_alerts(alerts, str(tmp_path / "csv"))
    assert sorted(map(tuple, read_alerts(spark, str(tmp_path / "csv")).collect()), key=lambda r: int(r[0])) == rows
    named = with_names(alerts.where("glean_text is not null"))
    for kind in ("csv", "parquet"):
        write_alerts(named, str(tmp_path / f"named-{kind}"), kind)
        back = read_alerts(spark, str(tmp_path / f"named-{kind}"), kind, named=True)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, named.collect()))


def test_null_policy_holds_for_any_source(spark, tmp_path):
    spark.sql("SELECT '1' AS id, CAST(1e30 AS DOUBLE) AS amount").write.parquet(str(tmp_path / "p"))
    spec = TableSpec(string_columns=("id",), float_columns=("amount",))
    assert ll.read_typed(spark, str(tmp_path / "p"), spec, format="parquet").collect()[0]["amount"] is None


def test_documented_config_run_writes_names(spark, tmp_path):
    result = ll.execute_config(spark, config(tmp_path), rules="documented")
    kinds = found(result, "glean_type", "glean_location")
    assert kinds and set(kinds) <= {
        ("vendor_not_seen_in_a_while", "invoice"),
        ("accrual_alert", "invoice"),
        ("large_month_increase_mtd", "vendor"),
        ("no_invoice_received", "vendor"),
    }


def test_versioned_sink_never_shows_half_a_result(spark, tmp_path):
    path = str(tmp_path / "alerts")
    alerts = ll.execute_config(spark, config(tmp_path)).cache()
    ll.write_alerts(alerts, path, versioned=True)
    before = found(ll.read_alerts(spark, path), *ll.ALERT_SCHEMA.names)
    assert before == found(alerts, *ll.ALERT_SCHEMA.names)
    failing = alerts.withColumn("glean_text", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        ll.write_alerts(failing, path, versioned=True)
    assert found(ll.read_alerts(spark, path), *ll.ALERT_SCHEMA.names) == before
    folder = ll.VersionedFolder(spark, path)
    base, content = folder.current()
    ll.write_alerts(alerts.limit(1), path, "parquet", versioned=True)
    assert ll.read_alerts(spark, path).count() == 1  # in the format it was written in
    with pytest.raises(ll.VersionConflict):
        folder.publish(base, content)
    folder.prune(set(), keep=1)
    assert ll.read_alerts(spark, path).count() == 1
    assert len(list((tmp_path / "alerts" / "parts").iterdir())) == 1


def test_versioned_output_of_a_configuration(spark, tmp_path):
    settings = config(tmp_path) | {"OutputVersioned": True}
    assert ll.execute_config(spark, settings).count() == 3
    assert ll.execute_config(spark, settings).count() == 3
    assert ll.VersionedFolder(spark, settings["OutputPath"]).current()[0] == 2


def test_rejected_values_are_kept(spark, tmp_path):
    bad = "x,yesterday,a,many,lots\nx,,,,\nx,2020-01-31,b,1,2.345\nx,2020-01-31,c\n"
    path = written(tmp_path, GOOD + bad, "extra,invoice_date,invoice_id,lines,total_amount\n\"p,q\",2020-02-30,d,3,1\n")
    clean, rejects = ll.read_with_rejects(spark, path, SPEC)
    assert found(clean, *SPEC.names) == found(ll.read_typed(spark, path, SPEC), *SPEC.names)
    assert clean.schema == ll.read_typed(spark, path, SPEC).schema
    row = "x,yesterday,a,many,lots"
    assert found(rejects, "column", "value", "reason", "row") == [
        (None, None, "malformed row", "x,2020-01-31,c"),
        ("invoice_date", "2020-02-30", "not a timestamp", '"p,q",2020-02-30,d,3,1'),
        ("invoice_date", "yesterday", "not a timestamp", row),
        ("lines", "many", "not a int", row),
        ("total_amount", "lots", "not a decimal(24,6)", row),
    ]
    assert {r["file"].rsplit("/", 1)[-1] for r in rejects.collect()} == {"part-0.csv", "part-1.csv"}
    assert "Format: CSV" not in clean._jdf.queryExecution().executedPlan().toString()


def test_types_of_undeclared_columns(spark, tmp_path):
    path = written(
        tmp_path,
        "id,n,big,x,day,moment,mixed,none,e\n"
        "0012,1,3000000000,1.5,2020-01-31,2020-01-31 10:00:00,1,,1e3\n"
        "7,-20,1,2,2020-1-1,2020-02-01 00:00:00,x,,.5\n"
        ",0,5,,2020-12-31,,,,-2.\n",
    )
    kinds = {r["column"]: (r["kind"], r["filled"]) for r in ll.column_kinds(spark.read.option("header", True).csv(path)).collect()}
    assert kinds == {
        "id": ("string", 2), "n": ("integer", 3), "big": ("float", 3), "x": ("float", 2), "day": ("datetime", 3),
        "moment": ("datetime", 2), "mixed": ("string", 2), "none": ("string", 0), "e": ("float", 3),
    }
    spec = ll.infer_spec(spark, path, declared=ll.TableSpec(string_columns=("n",)), columns=["n", "id", "x", "day"])
    assert (spec.string_columns, spec.float_columns, spec.datetime_columns) == (("n", "id"), ("x",), ("day",))
    assert ll.read_typed(spark, path, spec).count() == 3


def test_shared_invoices_give_the_same_alerts(spark, tmp_path):
    settings = config(tmp_path)
    names = ll.ALERT_SCHEMA.names
    for rules in ("code", "documented"):
        shared = ll.run_config(spark, settings, rules=rules, staged=True, shared=True)
        assert found(shared, *names) == found(ll.run_config(spark, settings, rules=rules), *names)
    plan = shared._jdf.queryExecution().executedPlan().toString()
    assert "Format: CSV" not in plan


def test_own_folder_is_removed(spark):
    folder = Path(run_folder(spark).removeprefix("file:"))
    ll.stage(spark.range(3))
    assert list(folder.iterdir())
    release(spark)
    assert not folder.exists()
    assert ll.stage(spark.range(3)).count() == 3  # and made anew where needed
