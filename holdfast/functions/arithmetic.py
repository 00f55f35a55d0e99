"""Small arithmetic expressions with the edge cases the metrics need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double; a zero denominator gives 0 instead of an error."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0)
    )


def round_half_even(value: Column, places: int) -> Column:
    """Round to ``places`` decimals, ties to even, in double arithmetic."""
    scale = float(10**places)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def edges_below(edges: Column, value: Column, most: int, inclusive: bool = False) -> Column:
    """How many of the sorted ``edges`` (at most ``most``) are below ``value``.

    A binary search written as a fold over halving steps, so a thousand edges cost ten steps.
    """
    steps = [1 << k for k in range(max(most, 1).bit_length() - 1, -1, -1)]

    def advance(position: Column, step: Column) -> Column:
        edge = F.get(edges, position + step - F.lit(1))
        passed = (edge <= value) if inclusive else (edge < value)
        return F.when(passed, position + step).otherwise(position)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)
