"""Exact money arithmetic on double columns.

Amounts are ``NUMERIC(12,2)`` at the source and doubles in the lake. Adding doubles
gives a result that depends on the order of rows, and casting each row to a decimal
costs several times the scan. Here a row becomes a whole number of cents, split in two
limbs, so that the sums are plain long additions: order-free, cheap in generated code,
and out of reach of overflow for 9e12 rows of the largest ``NUMERIC(12,2)`` value.

The functions take a column name or any SQL expression over columns. Being SQL text, a
formula reaches the planner in one call instead of one per operator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LIMB_BITS = 20
_LIMB = 1 << _LIMB_BITS

# Beyond this a double no longer holds single cents.
_EXACT_LIMIT = "1e13D"


def _round2(x: str) -> str:
    return (
        f"CASE WHEN abs({x}) < {_EXACT_LIMIT} "
        f"THEN signum({x}) * floor(abs({x}) * 100 + 0.5D) / 100.0D ELSE {x} END"
    )


def _cents(x: str) -> str:
    return f"CASE WHEN abs({x}) < {_EXACT_LIMIT} THEN floor({x} * 100 + 0.5D) END"


def _joined(high: str, low: str) -> str:
    return (
        f"CAST(CAST({high} AS DECIMAL(19,0)) * {_LIMB} "
        f"+ CAST({low} AS DECIMAL(19,0)) AS DOUBLE) / 100.0D"
    )


def _sum(amount: str) -> str:
    x = f"try_cast({amount} AS DOUBLE)"
    cents = _cents(x)
    exact = _joined(f"sum(shiftright({cents}, {_LIMB_BITS}))", f"sum({cents} & {_LIMB - 1}L)")
    rest = f"sum(CASE WHEN NOT abs({x}) < {_EXACT_LIMIT} THEN {x} END)"
    return f"coalesce({exact} + {rest}, {exact}, {rest})"


def _percent(part: str, whole: str) -> str:
    return f"try_divide(CAST({part} AS DOUBLE) * 100.0D, CAST({whole} AS DOUBLE))"


def round2(value: str) -> Column:
    """Round to two digits, halves away from zero, on the binary value itself."""
    return F.expr(_round2(value))


def sum_money(amount: str) -> Column:
    """Aggregate: the exact sum of an amount column, as a double.

    Values that are no amounts (NaN, infinite, beyond the exact range) are added as
    doubles, so they show in the result instead of vanishing from it.
    """
    return F.expr(_sum(amount))


def total_money(amount: str) -> Column:
    """Aggregate: the sum rounded to two digits."""
    return round2(_sum(amount))


def avg_money(amount: str) -> Column:
    """Aggregate: the mean of the non-null amounts, rounded to two digits."""
    return round2(f"try_divide({_sum(amount)}, count({amount}))")


def percent(part: str, whole: str) -> Column:
    """``part`` of ``whole`` in percent as a double; null for an empty whole."""
    return F.expr(_percent(part, whole))


def percent2(part: str, whole: str) -> Column:
    """The percentage rounded to two digits."""
    return round2(_percent(part, whole))


def signed_sums(amount: str, weight: str) -> dict[str, Column]:
    """Aggregates of amounts that count ``weight`` times, -1 to take one back: sums of the
    two limbs, and how many amounts are known and how many of them are no exact amounts.
    Adding such sums column by column adds the amounts."""
    x = f"try_cast({amount} AS DOUBLE)"
    cents = _cents(x)
    inexact = f"({x}) IS NOT NULL AND ({cents}) IS NULL"
    return {
        "high": F.expr(f"sum(coalesce({weight} * shiftright({cents}, {_LIMB_BITS}), 0L))"),
        "low": F.expr(f"sum(coalesce({weight} * ({cents} & {_LIMB - 1}L), 0L))"),
        "known": F.expr(f"sum(CASE WHEN ({amount}) IS NOT NULL THEN {weight} ELSE 0L END)"),
        "inexact": F.expr(f"sum(CASE WHEN {inexact} THEN {weight} ELSE 0L END)"),
    }


def _of_sums() -> str:
    return (
        "CASE WHEN inexact <> 0 THEN double('NaN') WHEN known <> 0 "
        f"THEN {_joined('high', 'low')} END"
    )


def total_of_sums() -> Column:
    """The total of :func:`signed_sums`; null without amounts, NaN if one is no amount."""
    return round2(_of_sums())


def mean_of_sums() -> Column:
    return round2(f"try_divide({_of_sums()}, known)")
