"""Typed table sources: CSV with a header, or any columnar format Spark reads."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.schema import SPEC_LISTS, TableSpec
from ledgerlark.sources.scratch import new_path


def read_typed(
    spark: SparkSession,
    path: str | list[str],
    spec: TableSpec,
    *,
    format: str = "csv",
    header: Sequence[str] | None = None,
    on_bad_value: str = "null",
    **options,
) -> DataFrame:
    """Read the declared columns of a table in their declared types.

    CSV columns are read as text and cast, so ids keep leading zeros and no pass over the data
    infers types. The file's columns are taken from ``header`` if given, otherwise from the
    header line of the first file; every other file is checked against them while it is read.
    """
    if spec.datetime_columns:
        require_utc(spark)
    if format == "csv":
        options = {"header": True, **options}
        columns = (
            list(header) if header else spark.read.options(**options).csv(path).columns
        )
        spec.require_present(columns, str(path))
        text = T.StructType([T.StructField(name, T.StringType()) for name in columns])
        raw = spark.read.schema(text).options(enforceSchema=False, **options).csv(path)
    else:
        raw = spark.read.format(format).options(**options).load(path)
        spec.require_present(raw.columns, str(path))
    return spec.project(raw, on_bad_value)


def require_utc(spark: SparkSession) -> None:
    """Dates and timestamps are read as UTC, which takes a session in that zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC (it is {zone})")


def checkpoint_folder(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def stage(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a table once as parquet to the shared checkpoint folder and read it back.

    Several detectors over a CSV table would parse it once each, all columns of every line; over
    the staged copy each reads its own few columns. It also cuts the lineage, and survives the
    loss of executors.
    """
    spark = df.sparkSession
    if folder:
        path = f"{folder.rstrip('/')}/staged-{uuid4().hex}"
    elif checkpoint_folder(spark):
        path = new_path(spark, "staged")
    else:
        raise ValueError("set spark.checkpoint.dir, or name a shared folder to stage tables in")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# --- values that do not parse ------------------------------------------------------------------

REJECTS = "file string, row string, column string, value string, reason string"
_CORRUPT = "_row_that_is_malformed"


def read_with_rejects(
    spark: SparkSession, path: str | list[str], spec: TableSpec, *, header: Sequence[str] | None = None, **options
) -> tuple[DataFrame, DataFrame]:
    """``read_typed`` of a CSV table, and (file, row, column, value, reason) for each value in it that
    is not NULL and does not parse, or for a row that has too few or too many values (``column`` and
    ``value`` are NULL then). ``row`` is the row's values as one CSV line.

    The files are parsed once, into a staged table that both outputs read.
    """
    if spec.datetime_columns:
        require_utc(spark)
    options = {"header": True, **options}
    columns = list(header) if header else spark.read.options(**options).csv(path).columns
    spec.require_present(columns, str(path))
    text = T.StructType([T.StructField(name, T.StringType()) for name in [*columns, _CORRUPT]])
    raw = spark.read.schema(text).options(columnNameOfCorruptRecord=_CORRUPT, **options).csv(path)
    raw = stage(raw.select("*", F.col("_metadata.file_path").alias("_file")))

    def bad(column: T.StructField):
        source, kind = F.col(f"`{column.name}`"), column.dataType.simpleString()
        found = F.struct(
            F.lit(column.name).alias("column"), source.alias("value"), F.lit(f"not a {kind}").alias("reason")
        )
        return F.when(source.isNotNull() & source.try_cast(column.dataType).isNull(), found)

    none = F.lit(None).cast("string")
    malformed = F.when(
        F.col(_CORRUPT).isNotNull(),
        F.struct(none.alias("column"), none.alias("value"), F.lit("malformed row").alias("reason")),
    )
    every = F.array(malformed, *[bad(c) for c in spec.schema if not isinstance(c.dataType, T.StringType)])
    line = F.coalesce(F.col(_CORRUPT), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in columns])))
    rejects = raw.select(
        F.col("_file").alias("file"), line.alias("row"), F.explode(F.filter(every, lambda x: x.isNotNull())).alias("r")
    ).select("file", "row", "r.*")
    return spec.project(raw, "null"), rejects


# --- types of undeclared columns ---------------------------------------------------------------

#: A whole number without leading zeros, so that ids such as 00123 stay text.
WHOLE = r"^[+-]?(0|[1-9][0-9]{0,17})$"
DECIMAL = r"^[+-]?(0|[1-9][0-9]*)?([0-9]\.|\.[0-9])?[0-9]*([eE][+-]?[0-9]+)?$"
LARGEST_INTEGER = 2**31 - 1


def column_kinds(texts: DataFrame) -> DataFrame:
    """(column, kind, filled): for each text column the narrowest of ``integer``, ``float``,
    ``datetime`` and ``string`` that all its values have, and how many are not NULL.

    One aggregate, combined map-side: a value has a set of kinds, and a column those all its values
    share. Integers are floats too; a column without values is text.
    """
    measures = []
    for n, name in enumerate(texts.columns):
        value = F.col(f"`{name}`")
        whole = value.rlike(WHOLE)
        small = whole & (F.abs(value.try_cast("bigint")) <= LARGEST_INTEGER)
        number = whole | (value.rlike(DECIMAL) & value.rlike("[0-9]") & value.try_cast("double").isNotNull())
        padded = value.rlike("^[+-]?0[0-9]")
        measures += [
            F.count(value).alias(f"filled_{n}"),
            F.bool_and(F.coalesce(small, F.lit(False)) | value.isNull()).alias(f"integer_{n}"),
            F.bool_and((F.coalesce(number, F.lit(False)) & ~padded) | value.isNull()).alias(f"float_{n}"),
            F.bool_and(
                (value.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}") & value.try_cast("timestamp").isNotNull()) | value.isNull()
            ).alias(f"datetime_{n}"),
        ]
    merged = texts.agg(*measures)
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.when(F.col(f"filled_{n}") == 0, "string")
            .when(F.col(f"integer_{n}"), "integer")
            .when(F.col(f"float_{n}"), "float")
            .when(F.col(f"datetime_{n}"), "datetime")
            .otherwise("string")
            .alias("kind"),
            F.col(f"filled_{n}").alias("filled"),
        )
        for n, name in enumerate(texts.columns)
    ]
    return merged.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def infer_spec(
    spark: SparkSession, path: str | list[str], *, declared: TableSpec | None = None, columns: Sequence[str] | None = None, **options
) -> TableSpec:
    """A spec of a CSV table's columns (or those of ``columns``): declared ones as declared, all others
    by one pass over their values (see ``column_kinds``)."""
    known = {c: n for n in SPEC_LISTS for c in getattr(declared, n, ())}
    raw = spark.read.options(header=True, **options).csv(path)
    wanted = list(columns) if columns else raw.columns
    open_columns = [c for c in wanted if c not in known]
    found = dict(known)
    if open_columns:
        texts = raw.select(*[F.col(f"`{c}`") for c in open_columns])
        found |= {row["column"]: f"{row['kind']}_columns" for row in column_kinds(texts).collect()}
    lists = {n: tuple(c for c in [*known, *open_columns] if found[c] == n) for n in SPEC_LISTS}
    return TableSpec(**lists, **({"float_type": declared.float_type} if declared else {}))
