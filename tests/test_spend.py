import pytest
from pyspark.sql import functions as F

from ledgerlark import large_months
from ledgerlark.functions.money import average_amount, from_units, percent_change, units
from ledgerlark.schema import MONEY
from tests.helpers import day, found, invoices


def months_of(spark, *rows, **options):
    table = invoices(spark, *[(v, f"i{n}", d, a) for n, (v, d, a) in enumerate(rows)])
    return found(large_months(table, **options), "canonical_vendor_id", "insight_date")


def steady(vendor, amount, months=range(1, 12), year=2020):
    return [(vendor, f"{year}-{m:02d}-05", amount) for m in months]


def test_band_edges_never_alert(spark):
    rows = []
    for vendor, amount in (
        ("at-100", "100"),
        ("over-100", "100.01"),
        ("at-1000", "1000"),
        ("under-1000", "999.99"),
        ("at-10000", "10000"),
        ("over-10000", "10000.01"),
        ("under-10000", "9999.99"),
        ("over-1000", "1000.01"),
    ):
        rows += steady(vendor, "0.01") + [(vendor, "2020-12-05", amount)]
    expected = ["over-100", "under-1000", "over-10000", "under-10000", "over-1000"]
    assert months_of(spark, *rows) == sorted((v, day("2020-12-01")) for v in expected)


def test_percentage_must_be_exceeded(spark):
    # spend e after one month of x: average (x + e) / 2; pct 50 needs e = 3x
    rows = [
        ("exactly-50", "2020-01-05", "5000"),
        ("exactly-50", "2020-02-05", "15000"),
        ("over-50", "2020-01-05", "4999.99"),
        ("over-50", "2020-02-05", "15000"),
    ]
    assert months_of(spark, *rows) == [("over-50", day("2020-02-01"))]
    # two earlier months of x: pct 200 is out of reach (e < 3 * average); nine are needed
    rows = steady("exactly-200", "900", range(1, 9)) + [("exactly-200", "2020-09-05", "3600")]
    rows += steady("over-200", "900", range(1, 9)) + [("over-200", "2020-09-05", "3600.01")]
    assert months_of(spark, *rows) == [("over-200", day("2020-09-01"))]
    rows = steady("exactly-500", "80", range(1, 12)) + [("exactly-500", "2020-12-05", "880")]
    rows += steady("over-500", "80", range(1, 12)) + [("over-500", "2020-12-05", "880.01")]
    assert months_of(spark, *rows) == [("over-500", day("2020-12-01"))]


def test_first_month_zero_and_negative_spend(spark):
    rows = [
        ("first", "2020-01-05", "50000"),
        ("negative", "2020-01-05", "-90000"),
        ("negative", "2020-02-05", "20000"),
        ("zero", "2020-01-05", "0"),
        ("zero", "2020-02-05", "20000"),
    ]
    assert months_of(spark, *rows) == [("zero", day("2020-02-01"))]


def test_trailing_year_counts_days(spark):
    # 2022-01-01 minus 365 days is 2021-01-01; 2021-01-01 minus 365 days is 2020-01-02
    inside = [("inside", "2021-01-05", "5000"), ("inside", "2022-01-05", "16000")]
    outside = [("outside", "2020-01-05", "5000"), ("outside", "2021-01-05", "16000")]
    assert months_of(spark, *inside, *outside) == [("inside", day("2022-01-01"))]


def test_copies_count_once_at_their_largest(spark):
    table = invoices(
        spark,
        ("v", "a", "2020-01-05", "100"),
        ("v", "b", "2020-02-05", "11000"),
        ("v", "b", "2020-02-05", "12000.5"),
        ("v", "b", "2020-02-05", None),
    )
    assert found(large_months(table), "insight_text") == [
        ("Monthly spend with `v` is $12000.50 (6050.25%) higher than average.",)
    ]


def test_large_amounts_keep_plain_digits(spark):
    table = invoices(
        spark, ("v", "a", "2020-01-05", "1"), ("v", "b", "2020-02-05", "1234567890123.45")
    )
    assert found(large_months(table), "insight_text") == [
        ("Monthly spend with `v` is $1234567890123.45 (617283945062.23%) higher than average.",)
    ]


def test_float_amounts_are_read_to_the_cent(spark):
    table = invoices(spark, ("v", "a", "2020-01-05", "10.10"), ("v", "b", "2020-02-05", "20000"))
    floats = table.withColumn("total_amount", table.total_amount.cast("float"))
    assert found(large_months(floats), "insight_text") == found(large_months(table), "insight_text")


def test_amounts_that_are_no_numbers_are_absent(spark):
    table = invoices(
        spark, ("v", "a", "2020-01-05", "10"), ("v", "b", "2020-01-05", "1"),
        ("v", "c", "2020-02-05", "20000"),
    )
    amount = "CASE invoice_id WHEN 'b' THEN double('NaN') ELSE double(total_amount) END"
    broken = table.selectExpr("canonical_vendor_id", "invoice_id", "invoice_date",
                              f"{amount} AS total_amount")
    expected = large_months(table.where("invoice_id != 'b'"))
    assert found(large_months(broken), "insight_text") == found(expected, "insight_text")


def test_nothing_qualifies_and_empty_input(spark):
    table = invoices(spark, ("v", "a", "2020-01-05", "10"))
    assert large_months(table).count() == 0
    assert large_months(table.limit(0)).count() == 0


def test_documented_rule(spark):
    rows = steady("v", "1000") + [("v", "2020-12-05", "10000")]
    table = invoices(spark, *[(v, f"i{n}", d, a) for n, (v, d, a) in enumerate(rows)])
    assert large_months(table).count() == 0
    assert found(large_months(table, rules="documented"), "insight_date", "insight_text") == [
        (day("2020-12-01"), "Monthly spend with v is $10000.00 (900.00%) higher than average")
    ]


def test_documented_lookback_is_calendar_months(spark):
    rows = [("v", "2020-01-05", "5000"), ("v", "2021-01-05", "16000"), ("v", "2022-02-05", "90000")]
    assert months_of(spark, *rows, rules="documented") == [("v", day("2021-01-01"))]
    assert months_of(spark, *rows, rules="documented", lookback_months=13) == [
        ("v", day("2021-01-01")),
        ("v", day("2022-02-01")),
    ]


def test_fractions_of_a_cent_add_up(spark):
    """3,000 invoices of 4 units of a thousandth make 12 a month; none is rounded to nothing."""
    history = [("v", f"h{m}", f"2020-{m:02}-01", "10") for m in range(1, 10)]
    table = invoices(spark, *history).withColumn("total_amount", F.col("total_amount").cast("double"))
    many = spark.range(3_000_000).select(
        F.lit("v").alias("canonical_vendor_id"),
        F.col("id").cast("string").alias("invoice_id"),
        F.lit("2020-10-05").cast("timestamp").alias("invoice_date"),
        F.lit(0.004).alias("total_amount"),
        F.lit(None).cast("timestamp").alias("period_end_date"),
    )
    alerts = large_months(table.unionByName(many))
    assert "$12000.00" in found(alerts, "insight_text")[0][0]


def test_huge_amounts_alert_and_what_does_not_fit_raises(spark):
    def table(amount):
        small = invoices(spark, *[("v", f"i{m}", f"2020-{m:02}-01", "10") for m in range(1, 10)])
        big = invoices(spark, ("v", "big", "2020-10-01"))
        wide = [df.withColumn("total_amount", F.col("total_amount").cast("double")) for df in (small, big)]
        return wide[0].unionByName(wide[1].withColumn("total_amount", F.lit(amount)))

    assert large_months(table(1e16)).count() == 1
    assert large_months(table(float("nan"))).count() == 0
    with pytest.raises(Exception, match="does not fit"):
        large_months(table(1e30)).count()


def test_rounding_and_change_of_either_sign(spark):
    rows = [(-50_000, 3, 10_000), (50_000, 3, 10_000), (-5_000, 1, 0), (5_000, 1, 0), (10**6, 4, 10**5)]
    df = spark.createDataFrame(rows, "total long, months long, spend long")
    average = average_amount(F.col("total"), F.col("months"))
    assert [str(r[0]) for r in df.select(average).collect()] == ["-0.02", "0.02", "-0.01", "0.01", "0.25"]
    change = percent_change(F.col("spend"), F.col("total"), F.col("months"))
    assert [str(r[0]) for r in df.where("total > 0 and spend > 0").select(change).collect()] == ["-40.00", "-60.00"]


def test_texts_print_cents(spark):
    """Amounts keep six decimals; what a sentence shows has two."""
    amounts = spark.createDataFrame([("205341.67",), ("10.005",), ("-3",), (None,)], "a string")
    shown = amounts.select(from_units(units(F.col("a").cast(MONEY))).cast("string").alias("a"))
    assert [row["a"] for row in shown.collect()] == ["205341.67", "10.01", "-3.00", None]
