"""The driver's order tables seen as invoices and line items (mappings M1 to M4)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.schema import MONEY


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str, vendor: Column) -> DataFrame:
    issued = F.col("o_orderdate").cast("timestamp")
    covered_days = (F.col("o_orderkey") % 120).cast("int")
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("invoice_id"),
        vendor.cast("string").alias("canonical_vendor_id"),
        issued.alias("invoice_date"),
        (issued + F.make_dt_interval(covered_days)).alias("period_end_date"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"),
    )


def sparse_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: one vendor per customer."""
    return _orders(spark, sf_dir, F.col("o_custkey"))


def dense_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: a hundred vendors, so that most months are active."""
    return _orders(spark, sf_dir, F.col("o_custkey") % 100)


def banded_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: line items as invoices of a part's vendor, scaled to reach every spend band."""
    cents = F.rint(F.col("l_extendedprice") * 100).cast("long")
    divisor = (
        F.when(F.col("l_orderkey") % 29 == 0, 100)
        .when(F.col("l_orderkey") % 31 == 0, 5)
        .otherwise(2000)
    )
    scaled = F.call_function("div", cents, divisor)
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("invoice_id"),
        F.col("l_partkey").cast("string").alias("canonical_vendor_id"),
        F.col("l_shipdate").cast("timestamp").alias("invoice_date"),
        (scaled.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(MONEY).alias("total_amount"),
    )


def untidy_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: times of day, missing vendors and dates, credit notes, amounts of less than a cent, copies,
    and invoices that come again three days later."""
    key = F.col("o_orderkey")
    again = F.filter(
        F.array(F.lit(0), F.when(key % 5 == 0, 3), F.when(key % 7 == 0, 0)), lambda days: days.isNotNull()
    )
    clock = F.make_dt_interval(F.col("later"), (key % 24).cast("int"), (key % 60).cast("int"))
    millionths = F.rint(F.col("o_totalprice") * 100).cast("decimal(18,0)") * 137
    signed = F.when(key % 11 == 0, -millionths).otherwise(millionths)
    return (
        _table(spark, sf_dir, "orders")
        .withColumn("later", F.explode(again))
        .select(
            key.cast("string").alias("invoice_id"),
            F.when(key % 97 != 0, (F.col("o_custkey") % 300).cast("string")).alias("canonical_vendor_id"),
            F.when(key % 89 != 0, F.col("o_orderdate").cast("timestamp") + clock).alias("invoice_date"),
            (signed * F.lit(Decimal("0.000001"))).cast(MONEY).alias("total_amount"),
        )
    )


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("invoice_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(
            "line_item_id"
        ),
        F.col("l_partkey").cast("string").alias("canonical_line_item_id"),
        F.col("l_shipdate").cast("timestamp").alias("period_end_date"),
        F.col("l_extendedprice").cast(MONEY).alias("total_amount"),
    )
