"""Place of a value among sorted cuts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def cuts_below(cuts: Column, value: Column, at_most: int, inclusive: bool = False) -> Column:
    """How many of the ascending ``cuts`` (an array of up to ``at_most`` entries) are below ``value``.

    ``inclusive`` also counts equal cuts. A binary search, so that many cuts
    cost few comparisons per row.
    """
    steps = [1 << b for b in reversed(range(max(at_most, 1).bit_length()))]

    def advance(place: Column, step: Column) -> Column:
        cut = F.get(cuts, place + step - 1)
        passed = (cut <= value) if inclusive else (cut < value)
        return F.when((place + step <= F.size(cuts)) & passed, place + step).otherwise(place)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def double_array(values) -> Column:
    """A constant array of doubles, parsed in one go."""
    if not len(values):
        return F.array().cast("array<double>")
    return F.expr(f"array({', '.join(f'{float(v)!r}D' for v in values)})")
