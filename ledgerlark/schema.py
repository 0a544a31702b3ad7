"""Table specs, the alert schema and the column contracts every detector checks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Amounts keep six decimals, so usage-priced invoices of fractions of a cent add up.
MONEY = T.DecimalType(24, 6)

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("glean_id", T.StringType()),
        T.StructField("glean_date", T.DateType()),
        T.StructField("glean_text", T.StringType()),
        T.StructField("glean_type", T.IntegerType()),
        T.StructField("glean_location", T.IntegerType()),
        T.StructField("invoice_id", T.StringType()),
        T.StructField("canonical_vendor_id", T.StringType()),
    ]
)

DATE_LIKE = (T.DateType, T.TimestampType, T.TimestampNTZType)
NUMERIC = (T.NumericType,)
ID_LIKE = (T.StringType,)


@dataclass(frozen=True)
class InvoiceColumns:
    """Names of the input columns, so a detector can run on any naming scheme."""

    vendor: str = "canonical_vendor_id"
    invoice: str = "invoice_id"
    date: str = "invoice_date"
    amount: str = "total_amount"
    period_end: str = "period_end_date"
    line_item: str = "line_item_id"


SPEC_LISTS = ("string_columns", "float_columns", "integer_columns", "datetime_columns")


@dataclass(frozen=True)
class TableSpec:
    """Declared columns of a source table, by type. Undeclared columns are dropped."""

    string_columns: tuple[str, ...] = ()
    float_columns: tuple[str, ...] = ()
    integer_columns: tuple[str, ...] = ()
    datetime_columns: tuple[str, ...] = ()
    float_type: T.DataType = field(default=MONEY)

    def __post_init__(self) -> None:
        for name in SPEC_LISTS:
            object.__setattr__(self, name, tuple(getattr(self, name)))
        repeated = sorted(c for c, n in Counter(self.names).items() if n > 1)
        if repeated:
            raise ValueError(f"columns declared more than once: {', '.join(repeated)}")
        if not self.names:
            raise ValueError("a table spec must declare at least one column")

    @property
    def schema(self) -> T.StructType:
        typed = [
            (self.string_columns, T.StringType()),
            (self.float_columns, self.float_type),
            (self.integer_columns, T.IntegerType()),
            (self.datetime_columns, T.TimestampType()),
        ]
        return T.StructType(
            [T.StructField(name, dtype) for names, dtype in typed for name in names]
        )

    @property
    def names(self) -> list[str]:
        return [
            *self.string_columns,
            *self.float_columns,
            *self.integer_columns,
            *self.datetime_columns,
        ]

    def require_present(self, available: Iterable[str], where: str) -> None:
        missing = sorted(set(self.names) - set(available))
        if missing:
            raise ValueError(f"columns missing from {where}: {', '.join(missing)}")

    def project(self, df: DataFrame, on_bad_value: str = "null") -> DataFrame:
        """Keep the declared columns, each in its declared type.

        ``on_bad_value="null"`` turns values that do not parse into NULL, ``"fail"`` raises.
        """
        if on_bad_value not in ("null", "fail"):
            raise ValueError(f"on_bad_value must be 'null' or 'fail', not {on_bad_value!r}")

        def typed(column: T.StructField) -> Column:
            source = F.col(f"`{column.name}`")
            if on_bad_value == "null":
                return source.try_cast(column.dataType).alias(column.name)
            return source.cast(column.dataType).alias(column.name)

        return df.select(*[typed(column) for column in self.schema])


INVOICE_SPEC = TableSpec(
    string_columns=("invoice_id", "canonical_vendor_id"),
    float_columns=("total_amount",),
    datetime_columns=("invoice_date", "due_date", "period_start_date", "period_end_date"),
)

LINE_ITEM_SPEC = TableSpec(
    string_columns=("invoice_id", "line_item_id", "canonical_line_item_id"),
    float_columns=("total_amount",),
    datetime_columns=("period_start_date", "period_end_date"),
)


def require_types(df: DataFrame, contract: Mapping[str, tuple[type, ...]], who: str) -> None:
    """Raise while the plan is being built if a column is absent or of the wrong kind."""
    problems = []
    for name, kinds in contract.items():
        if name not in df.columns:
            problems.append(f"{name} is missing")
        elif not isinstance(df.schema[name].dataType, kinds):
            problems.append(f"{name} is {df.schema[name].dataType.simpleString()}")
    if problems:
        raise TypeError(f"{who}: {'; '.join(problems)}")


def require_rules(rules: str) -> None:
    if rules not in ("code", "documented"):
        raise ValueError(f"rules must be 'code' or 'documented', not {rules!r}")
