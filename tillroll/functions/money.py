"""Money and ratio expressions.

Money stays exact: line prices are DECIMAL(18,4), sums DECIMAL(38,4), so a sum
does not depend on the order rows arrive in after a shuffle. Ratios are taken
in double from exact operands (``exact sum -> double -> divide``), which gives
the same bits on any engine. Rounding is half away from zero on decimals where the
original rounds numeric values, half to even where it rounds data frames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_TYPE = "decimal(18,4)"
SUM_TYPE = "decimal(38,4)"


def amount(price: str = "price", quantity: str = "quantity") -> Column:
    """Line amount = price x quantity, exact."""
    return (F.col(price) * F.col(quantity)).cast(SUM_TYPE)


def money_sum(c: Column) -> Column:
    return F.sum(c).cast(SUM_TYPE)



def ratio(num: Column, den: Column) -> Column:
    """num / den in double; NULL when den is 0 (ANSI division would raise)."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def exact_mean(c: Column) -> Column:
    """Mean as exact sum / count, converted once to double (order independent)."""
    return F.sum(c).cast("double") / F.count(c).cast("double")


def exact_sum(c: Column) -> Column:
    """Sum of doubles as decimals of six digits: independent of the order of rows."""
    return F.sum(c.cast("decimal(28,6)"))


def round_to(c: Column, digits: int) -> Column:
    """ROUND of a numeric value: half away from zero at ``digits`` decimals, taken
    on the decimal value (eight digits), as a double."""
    return F.round(c.cast("decimal(38,8)"), digits).cast("double")


def round_even(c: Column, digits: int) -> Column:
    """Rounding as numpy's: half to even on the scaled double."""
    scale = float(10**digits)
    return F.rint(c.cast("double") * F.lit(scale)) / F.lit(scale)
