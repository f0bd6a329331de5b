"""Exact money helpers.

Money is carried as DECIMAL so that sums are exact and independent of the
order in which partitions are combined.  Divisions that feed a rounded output
are done on integer cents and rounded half away from zero, so that a value
sitting exactly on a rounding tie (common with two-decimal prices) rounds the
same way on every engine.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE = "decimal(12,2)"
MONEY = "decimal(18,2)"


def cents(c: Column) -> Column:
    """A value with at most two decimals (double or decimal) as BIGINT cents.

    x * 100 lies within 1e-9 of an integer, so floor(x * 100 + 0.5) is exact
    and stays in cheap double arithmetic (no BigDecimal per row)."""
    return F.floor(c.cast("double") * 100 + 0.5).cast("bigint")


def from_cents(c: Column, dtype: str = PRICE) -> Column:
    """BIGINT cents back to an exact decimal."""
    return (c.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(dtype)


def div_half_up(num: Column, den: Column) -> Column:
    """round(num / den) half away from zero for integer num and den > 0.

    floor((2|n| + d) / 2d) is computed in double; for |n| < 2**50 and d < 2**31
    the quotient is never within one ulp of an integer unless it is one, so the
    floor is exact.
    """
    a = F.abs(num)
    q = F.floor((a * 2 + den) / (den * 2)).cast("bigint")
    return F.when(num < 0, -q).otherwise(q)


def ratio_round(num: Column, den: Column, digits: int) -> Column:
    """num / den rounded half away from zero to ``digits`` decimals (double).

    num and den are integers (cents or units); den must be > 0.
    """
    scale = 10 ** digits
    return div_half_up(num * scale, den).cast("double") / F.lit(float(scale))


def money_out(c: Column) -> Column:
    """Round an exact money expression to cents and expose it as DOUBLE."""
    return F.round(c, 2).cast("double")


def round_out(c: Column, digits: int = 2) -> Column:
    """Round a DOUBLE measure half-up and keep it DOUBLE."""
    return F.round(c.cast("double"), digits)


NUM = "decimal(24,4)"
DEN = "decimal(22,4)"
WIDE = "decimal(34,4)"


def dec_div(num: Column, den: Column, digits: int) -> Column:
    """round(num / den, digits) half up, as DOUBLE, from exact decimals.

    Both sides are cast to bounded decimals first so that Spark's decimal
    division keeps at least 14 fractional digits; rounding that quotient
    again to ``digits`` cannot cross a tie except for a value within 1e-14 of
    it.  Scale the numerator (e.g. * 100 for a percent) before calling."""
    return F.round(num.cast(NUM) / den.cast(DEN), digits).cast("double")


def dec_div_wide(num: Column, den: Column, digits: int) -> Column:
    """``dec_div`` for a product of two sums, which soon has more than NUM's
    20 integer digits (30 are held here).

    The whole quotient and the rest, which is smaller than ``den``, are divided
    apart: the first is an integer, the second keeps 16 fractional digits."""
    num, den = num.cast(WIDE), den.cast(DEN)
    rest = num % den
    whole = ((num - rest) / den).cast("decimal(30,0)")
    return (whole + F.round(rest / den, digits)).cast("double")


def dec_mean(c: Column, digits: int) -> Column:
    """Exact mean of a decimal or integer column, rounded half up (aggregate)."""
    n = F.count(c)
    return dec_div(F.sum(c), F.when(n != 0, n), digits)


def round_half_up_double(x: Column, digits: int) -> Column:
    """floor(x * 10^d + 0.5) / 10^d on DOUBLE: the same IEEE operations on
    every engine, so a value printing as an exact tie rounds identically."""
    scale = float(10 ** digits)
    return F.floor(x * scale + 0.5).cast("double") / F.lit(scale)
