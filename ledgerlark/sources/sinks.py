"""Writing the alert table and reading it back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.schema import ALERT_SCHEMA
from ledgerlark.sources.versions import VersionedFolder

#: Codes written by name instead of number (see ``with_names``).
NAMED_ALERT_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name in ("glean_type", "glean_location") else f.dataType)
        for f in ALERT_SCHEMA
    ]
)
#: NULL is written so, which no escaped text can look like; an empty text is quoted.
NULL_MARK = "\\N"
CSV = {"header": True, "escape": '"', "nullValue": NULL_MARK}


def _escaped(text: Column) -> Column:
    """Line breaks and backslashes as two characters each, so that a row is one line."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _plain(text: Column) -> Column:
    parts = F.split(text, r"\\\\", -1)  # between doubled backslashes
    undone = F.transform(
        parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    )
    return F.array_join(undone, "\\")


def _texts(df: DataFrame, change) -> DataFrame:
    return df.select(
        *(
            change(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema
        )
    )


def write_alerts(alerts: DataFrame, path: str, format: str = "csv", *, versioned: bool = False) -> None:
    """Overwrite ``path`` with the alerts: CSV with a header, or parquet split by type.

    In CSV a NULL is ``\\N``, a line break ``\\n`` or ``\\r`` and a backslash ``\\\\``; blanks stay.
    Overwriting removes the old alerts before the new ones are there. With ``versioned`` they are
    written aside and then named by a manifest, which ``read_alerts`` follows: a run that fails, or
    loses against another one (``VersionConflict``), leaves the alerts before it readable.
    """
    if versioned:
        folder = VersionedFolder(alerts.sparkSession, path)
        base, part = folder.current()[0], folder.new_part()
        write_alerts(alerts, part, format)
        folder.publish(base, {"alerts": part, "format": format})
        return
    if format == "csv":
        options = CSV | {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        _texts(alerts, _escaped).write.mode("overwrite").options(**options).csv(path)
    elif format == "parquet":
        alerts.write.mode("overwrite").partitionBy("glean_type").parquet(path)
    else:
        raise ValueError(f"format must be 'csv' or 'parquet', not {format!r}")


def read_alerts(spark: SparkSession, path: str, format: str = "csv", *, named: bool = False) -> DataFrame:
    """Read alerts written by ``write_alerts``, with the alert schema and no inference.

    ``named`` says that type and location were written by name. A malformed CSV row raises. Where
    ``path`` has versions, the newest is read, in the format it was written in.
    """
    version, content = VersionedFolder(spark, path).current()
    if version:
        path, format = content["alerts"], content["format"]
    schema = NAMED_ALERT_SCHEMA if named else ALERT_SCHEMA
    reader = spark.read.schema(schema)
    if format == "csv":
        return _texts(reader.options(**CSV, mode="FAILFAST").csv(path), _plain)
    if format == "parquet":
        return reader.parquet(path).select(*schema.names)
    raise ValueError(f"format must be 'csv' or 'parquet', not {format!r}")
