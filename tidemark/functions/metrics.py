"""Aggregate and ratio expressions with warehouse-style decimal results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Result types of rounded gold metrics.
MONEY_TOTAL = "decimal(22,2)"
MONEY = "decimal(18,2)"
PERCENT = "decimal(18,2)"
RATE6 = "decimal(18,6)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_when(pred: Column) -> Column:
    """count(case when pred then 1 end)."""
    return F.count(F.when(pred, F.lit(1)))


def rounded_ratio(num, den, scale: int, out_type: str) -> Column:
    """round(num / nullif(den, 0), scale) in exact decimal arithmetic.

    ``num`` is cast to decimal so the quotient is a decimal (half-up rounding),
    never a double; a zero or null denominator yields null instead of an error.
    """
    num, den = _col(num), _col(den)
    # decimal(22,4) / decimal(20,0) keeps 20 fractional digits before rounding.
    q = num.cast("decimal(22,4)") / F.nullif(den, F.lit(0)).cast("decimal(20,0)")
    return F.round(q, scale).cast(out_type)


def pct(num, den) -> Column:
    """round(num / nullif(den, 0) * 100, 2) for counts, as decimal."""
    num, den = _col(num), _col(den)
    q = (num.cast("decimal(20,0)") * F.lit(100)) / F.nullif(den, F.lit(0)).cast("decimal(20,0)")
    return F.round(q, 2).cast(PERCENT)


def exact_avg(total, n, scale: int, out_type: str) -> Column:
    """Average from a decimal sum and a count, rounded half-up at ``scale``.

    An average of a decimal keeps a fixed scale (the argument's scale for the
    unrounded models, 2 or 6 where a model rounds); computing it from the exact
    sum and count avoids rounding twice. Pass the sum at its natural width
    (e.g. decimal(22,4)): the quotient then keeps about 20 fractional digits
    before the final rounding.
    """
    total, n = _col(total), _col(n)
    q = total / F.nullif(n, F.lit(0)).cast("decimal(20,0)")
    return F.round(q, scale).cast(out_type)
