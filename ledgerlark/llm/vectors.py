"""What the two vector searches share: usable vectors, distinct ones, and the final ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlark.llm.columns import quoted


def usable_vectors(table: DataFrame, *, id: str, vector: str, allow_zero: bool = False) -> DataFrame:
    """(id, vec): rows with an id and a vector whose components are all numbers and finite.

    Zero vectors go too unless allowed. Of several dimensions the one with most rows stays (the
    larger one of equals): a nearness between different dimensions has no meaning. Rows equal in
    both columns count once.
    """
    chosen = table.select(quoted(id).cast("bigint").alias("id"), quoted(vector).cast("array<double>").alias("vec"))

    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    good = chosen.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)).where(
        ~F.exists("vec", bad)
    )
    if not allow_zero:
        good = good.where(F.exists("vec", lambda x: x != 0))
    sizes = good.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = sizes[0]["d"] if sizes else 0
    return good.where(F.size("vec") == d).distinct()


def distinct_values(rows: DataFrame, value: str, keep: int) -> DataFrame:
    """(vid, value, ids): each distinct value once, with its ``keep`` smallest ids.

    The ids are cut to ``keep`` in every task before they are shuffled, so a value that a third of
    all rows share sends a few rows a task. ``vid`` is the smallest id with the value; as one id may
    come with several values, it is made unique by the value's hash.
    """
    smallest = W.partitionBy(value).orderBy("id")
    return (
        rows.select("id", value)
        .withColumn("n", F.row_number().over(smallest))
        .where(F.col("n") <= keep)
        .groupBy(value)
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
        .select(F.struct(F.col("ids")[0].alias("id"), F.xxhash64(value).alias("h")).alias("vid"), value, "ids")
    )


def ranked(found: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each query_id by ``order``, numbered from 1."""
    best = W.partitionBy("query_id").orderBy(*order)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
