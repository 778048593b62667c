"""Money and ratio expressions.

Sums stay decimal and are rounded as decimals. Averages and ratios are doubles and are only ever
rounded to whole numbers before a final division, because whole-number rounding of a double is
the same in every engine while rounding to one or two digits is not.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F, types as T

_WIDE = T.DecimalType(28, 2)


def total_amount(quantity: Column, unit_price: Column, money: T.DecimalType) -> Column:
    """Quantity times unit price, rounded to exact money; NULL, which a rule rejects, when it does not fit the type."""
    return (quantity * unit_price).try_cast(money)


def in_millions(amount: Column, digits: int) -> Column:
    """An amount in millions, rounded half up to ``digits`` decimals."""
    millionth = F.lit(Decimal("0.000001")).cast(T.DecimalType(7, 6))
    return F.round(amount.cast(_WIDE) * millionth, digits).cast(T.DecimalType(18, 2))


def whole(amount: Column) -> Column:
    """An amount rounded half up to whole units."""
    return F.round(amount, 0).cast(_WIDE)


def mean(total: Column, count: Column) -> Column:
    """Average of exact money as a double, rounded half up to whole units."""
    return F.round(total.cast("double") / count, 0)


def in_thousands(average: Column) -> Column:
    """An average in thousands, rounded half up to one decimal."""
    return F.round(average / F.lit(100.0), 0) / F.lit(10.0)


def percent(part: Column, whole_count: Column) -> Column:
    """Share in percent, rounded half up to one decimal; NULL when the whole is zero."""
    return F.when(whole_count != 0, F.round(part * F.lit(1000.0) / whole_count, 0) / F.lit(10.0))
