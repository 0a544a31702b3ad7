"""Column names that clash with nothing in the caller's table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until the table has no such column (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str):
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")
