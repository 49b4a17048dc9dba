"""Column expressions for numbers whose value must not depend on evaluation order.

* Sums of money are taken in exact integer cents (``long``) and only then
  turned into ``double`` (cents / 100.0, which equals the correctly rounded
  value of the decimal sum); a double sum depends on the order of its terms,
  an integer sum does not, and long arithmetic is several times faster than
  ``decimal(38,2)``.
* Rounding is done on the scaled double (``x * 10^d``), which is what numpy's
  ``round`` does.  ``round_half_even`` therefore equals pandas ``.round(d)``,
  ``round_half_up`` equals the usual ``round(x, d)`` of SQL engines.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, digits: int = 6) -> Column:
    scale = float(10 ** digits)
    return F.round(_col(c) * F.lit(scale), 0) / F.lit(scale)


def round_half_even(c, digits: int = 1) -> Column:
    scale = float(10 ** digits)
    return F.bround(_col(c) * F.lit(scale), 0) / F.lit(scale)


def safe_div(num, den) -> Column:
    """Null instead of an error (ANSI) or NaN when the divisor is 0 or null."""
    return F.try_divide(_col(num), _col(den))


def to_money(c) -> Column:
    """Exact decimal of a double that holds units * price (price has 2 decimals)."""
    return _col(c).cast(MONEY)


def dec_sum(c) -> Column:
    """Order-independent sum of a money column, returned as decimal."""
    return F.sum(to_money(c))


def cents(c) -> Column:
    """Exact integer cents of a money double (units * a 2-decimal price)."""
    return F.round(_col(c) * F.lit(100.0)).cast("long")


def cents_sum(c) -> Column:
    """Order-independent sum of a money column, in cents (long)."""
    return F.sum(cents(c))


def money(cents_col) -> Column:
    """Cents (long) back to a money double."""
    return _col(cents_col) / F.lit(100.0)
