"""Exact-decimal money helpers (Column -> Column).

All amounts stay ``DecimalType``; nothing is rounded on a double. ``pct / 100``
is written as ``pct * 0.01`` and held at 8 decimal places, which is exact for
percentages and rates of up to 6; the model refuses wider ones when it is
loaded. A product of quantity, price and one such factor is exact (37 digits);
with two factors Spark keeps 12 decimal places.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# SQL Server ``money``: 4 decimal places, cast rounds half away from zero
# (Spark's decimal cast does the same).
MONEY = DecimalType(19, 4)
# Rounded line amount (2 dp).
AMOUNT = DecimalType(18, 2)
# A percentage turned into a multiplier, e.g. 17.555 -> 0.17555.
FACTOR = DecimalType(12, 8)
# Quantity times price, and the operands of a quotient.
PRODUCT = DecimalType(24, 8)


def _cent() -> Column:
    return F.lit(Decimal("0.01"))


def money(c: Column) -> Column:
    return c.cast(MONEY)


def round2(c: Column) -> Column:
    """ROUND(x, 2) on an exact decimal: half away from zero."""
    return F.round(c, 2)


def pct_factor(pct: Column) -> Column:
    """``pct / 100`` as an exact narrow decimal."""
    return (pct * _cent()).cast(FACTOR)


def one_minus_pct(pct: Column) -> Column:
    """``1 - pct / 100`` as an exact narrow decimal."""
    return (F.lit(1) - pct * _cent()).cast(FACTOR)


def rate_or_zero(rate: Column) -> Column:
    """``ISNULL(rate, 0) / 100`` — a missing VAT rate counts as 0 %."""
    return pct_factor(F.coalesce(rate, F.lit(0)))


def signed_by_credit(credit: Column, x: Column) -> Column:
    """``CASE credit WHEN 1 THEN -x ELSE x END`` (a NULL flag is not a credit)."""
    return F.when(credit == F.lit(True), -x).otherwise(x)


def product(qty: Column, price: Column) -> Column:
    """Quantity times price, exact, in a width that leaves room for a factor."""
    return (qty * price).cast(PRODUCT)


def money_ratio(num: Column, den: Column) -> Column:
    """``num / den`` for two money values: the quotient truncated to 4 dp.

    SQL Server keeps money / money at money scale by cutting the digits after
    the fourth. The decimals are divided as they are, to a whole number.
    """
    q = F.call_function("div", num.cast(PRODUCT) * F.lit(Decimal(10000)), den.cast(PRODUCT))
    return (q.cast("decimal(20,0)") * F.lit(Decimal("0.0001"))).cast("decimal(24,4)")


def percent_round2(num: Column, den: Column) -> Column:
    """``ROUND(100 * num / den, 2)`` exactly, half away from zero."""
    n, d = F.abs(num.cast(PRODUCT)), F.abs(den.cast(PRODUCT))
    q = F.call_function("div", n * F.lit(Decimal(20000)) + d, d * F.lit(Decimal(2)))
    q = F.when((num < 0) != (den < 0), -q).otherwise(q)
    return (q.cast("decimal(20,0)") * _cent()).cast("decimal(22,2)")
