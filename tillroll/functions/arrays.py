"""Arithmetic on the value array of one short series."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def array_mean(a: Column) -> Column:
    """Mean, NULL for an empty array."""
    return F.try_divide(array_sum(a), F.size(a))


def last_of(a: Column, k: int) -> Column:
    """The last ``k`` elements, all of them when there are fewer."""
    return F.slice(a, F.greatest(F.size(a) - k, F.lit(0)) + 1, F.lit(k))


def steps(n: int | Column) -> Column:
    return F.sequence(F.lit(1), n if isinstance(n, Column) else F.lit(n))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def array_quantile(a: Column, p: float) -> Column:
    """Interpolated quantile of a small array."""
    def pick(ordered: Column) -> Column:
        at = (F.size(ordered) - 1) * F.lit(p)
        low = F.get(ordered, F.floor(at).cast("int"))
        high = F.get(ordered, F.ceil(at).cast("int"))
        return low + (high - low) * (at - F.floor(at))

    return let(F.array_sort(a), pick)
