"""Exact spend arithmetic: no floating point, so results never depend on summing order.

Amounts are counted in units of a millionth, as whole decimals. Sums and products of whole decimals
lose no digits; only what is printed is rounded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.schema import MONEY

UNITS = 10**MONEY.scale
WHOLE = "decimal(30,0)"


def exact_amount(amount: Column, kind: T.DataType) -> Column:
    """An amount with six decimals. NaN and infinity count as absent; what is too large raises."""
    exact = amount.try_cast(MONEY)
    lost = amount.isNotNull() & exact.isNull()
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        lost = lost & ~F.isnan(amount) & (F.abs(amount) != float("inf"))
    message = F.concat(F.lit(f"an amount does not fit {MONEY.simpleString()}: "), amount.cast("string"))
    return F.when(lost, F.raise_error(message).cast(MONEY)).otherwise(exact)


def units(amount: Column) -> Column:
    """An amount as a whole number of units."""
    return (amount * UNITS).cast(WHOLE)


def _divided(numerator: Column, denominator: Column) -> Column:
    """Whole quotient of non-negative whole decimals, without the limits of a long."""
    return ((numerator - numerator % denominator) / denominator).cast("decimal(38,0)")


def rounded_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` rounded to a whole number, halves away from zero.

    The denominator must be positive, the numerator may have either sign."""
    whole = _divided(F.abs(numerator) * 2 + denominator, denominator * 2)
    return F.when(numerator < 0, -whole).otherwise(whole)


def _hundredths(value: Column) -> Column:
    return (value.cast("decimal(36,0)") / 100).cast("decimal(38,2)")


def from_units(value: Column) -> Column:
    """Units back to an amount, rounded to two decimals."""
    return _hundredths(rounded_ratio(_wide(value), F.lit(UNITS // 100).cast("decimal(8,0)")))


def average_amount(total: Column, count: Column) -> Column:
    """``total / count`` to the cent, for a total in units."""
    return _hundredths(rounded_ratio(_wide(total), _count(count) * (UNITS // 100)))


def percent_change(spend: Column, total: Column, count: Column) -> Column:
    """How far ``spend`` lies above (or, negative, below) ``total / count``, in percent with two
    decimals. ``total`` must be positive. All amounts are in units."""
    excess = _wide(spend) * _count(count) - _wide(total)
    return _hundredths(rounded_ratio(excess * 10000, _wide(total)))


def exceeds_average_by(spend: Column, total: Column, count: Column, percent: int) -> Column:
    """Whether ``spend`` is more than ``percent`` % above ``total / count``, all in units.

    Cross-multiplied form of ``100 * (spend - total/count) / (total/count) > percent``.
    """
    return _wide(spend) * _count(count) * 100 > _wide(total) * (100 + percent)


def _wide(value: Column) -> Column:
    return value.cast(WHOLE)


def _count(value: Column) -> Column:
    return value.cast("decimal(10,0)")
