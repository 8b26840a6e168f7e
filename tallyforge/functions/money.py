"""Sums and ratios of money columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Eighteen digits before the point and ten behind it; a sum has ten more before it.
AMOUNT = "decimal(28,10)"


def money_sum(amount: Column) -> Column:
    """Sum of amounts held as doubles, exact and independent of the order of rows.

    Amounts are summed as decimals, with the digits a double prints as, up to ten behind the
    point. An amount of 10^18 or more raises an error, and so would a sum of 10^28. NULLs are
    skipped. NaN and infinities make the total what adding doubles makes it.
    """
    finite = ~F.isnan(amount) & (F.abs(amount) < float("inf"))
    exact = F.when(finite, amount).try_cast(AMOUNT)
    too_big = F.raise_error(F.concat(F.lit("amount out of range: "), amount.cast("string")))
    checked = F.when(finite & exact.isNull(), too_big.cast(AMOUNT)).otherwise(exact)
    total = F.try_sum(checked)
    lost = F.raise_error(F.lit("the sum of the amounts is out of range")).cast("double")
    total = F.when(total.isNull() & (F.count(checked) > 0), lost).otherwise(total.cast("double"))
    return F.coalesce(F.sum(F.when(~finite, amount)), total)


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is zero."""
    return F.try_divide(part, whole) * 100
