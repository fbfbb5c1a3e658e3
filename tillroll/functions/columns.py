"""Scalar and aggregate column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Binary noise puts a product such as 1.005 just below its decimal tie. The
# nudge is far below a cent and far above that noise.
TIE_NUDGE = 1e-7


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded(c: Column | str, digits: int = 4) -> Column:
    """Half-up rounding that does not split ties on binary noise."""
    return F.round(col(c) + F.lit(TIE_NUDGE), digits)


def money(c: Column | str) -> Column:
    """An amount in whole cents."""
    return rounded(c, 2)


def total(c: Column | str) -> Column:
    """Sum in which an all-missing group is 0, not NULL."""
    return F.coalesce(F.sum(col(c)), F.lit(0.0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def distinct_with_missing(c: Column | str) -> Column:
    """Distinct count in which a missing value is one more value."""
    return F.count_distinct(col(c)) + F.coalesce(F.max(col(c).isNull().cast("int")), F.lit(0))


def first_known(c: str, order_by: str | None = None) -> Column:
    """First non-missing value in ``order_by`` order.

    Without an ordering column the smallest value is taken, so the answer does
    not depend on how the rows were shuffled.
    """
    if order_by is None:
        return F.min(c)
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order_by)))


def blank_to_null(c: Column | str) -> Column:
    trimmed = F.trim(col(c))
    return F.when(trimmed != "", trimmed)


def is_placeholder(c: Column | str, token: str = "N/A") -> Column:
    return F.upper(F.trim(col(c))) == F.lit(token.upper())


def paid_ratio(initial: Column | str, final: Column | str, corrected: bool = False) -> Column:
    """Share of the initial price that is still paid.

    The default follows the established table: missing, non-positive or raised
    prices give 0 and a final price of 0 or less gives the absolute reduction.
    ``corrected`` returns NULL for unusable prices and 1 for raised ones.
    """
    before, after = col(initial).cast("double"), col(final).cast("double")
    unusable = before.isNull() | after.isNull() | (before <= 0)
    if corrected:
        return F.when(
            ~unusable, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(after, before)))
        )
    cut = before - after
    return (
        F.when(unusable | (cut < 0), F.lit(0.0))
        .when(F.try_divide(cut, before) < 1, F.lit(1.0) - F.try_divide(cut, before))
        .otherwise(cut)
    )


def safe_rate(c: Column | str, upper: float = 0.9) -> Column:
    """Rate from any text: not a number is 0, the rest is clipped."""
    number = F.coalesce(col(c).try_cast("double"), F.lit(0.0))
    return F.least(F.greatest(number, F.lit(0.0)), F.lit(upper))


def safe_price(c: Column | str, floor: float = 0.01) -> Column:
    """Price from any text, never below ``floor``."""
    return F.greatest(F.coalesce(col(c).try_cast("double"), F.lit(0.0)), F.lit(floor))


def adjusted_rate(rate: Column | str) -> Column:
    """Discount taken from a paid ratio; values outside [0, 1] are kept."""
    r = col(rate)
    return F.when(r.between(0.0, 1.0), F.lit(1.0) - r).otherwise(r)


def finite_or_zero(c: Column | str) -> Column:
    """NULL, NaN and infinities become 0."""
    x = col(c).cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), 0.0).otherwise(x)


def title_case(c: Column | str) -> Column:
    """Capital after every break, hyphens included (``initcap`` splits on blanks only)."""
    return F.regexp_replace(
        F.initcap(F.regexp_replace(col(c), r"([^\p{L}\p{N} ])", "$1\u0001 ")), "\u0001 ", ""
    )


def price_band(
    c: Column | str, edges: Sequence[float], labels: Sequence[str], right: bool
) -> Column:
    """Label of the interval holding ``c``; the last one is open above.

    ``right`` closes the intervals on the right, ``(a, b]``, so the lowest edge
    itself falls outside; otherwise they are ``[a, b)``.
    """
    x = col(c)
    band = None
    for i, label in enumerate(labels):
        low = F.lit(float(edges[i]))
        inside = x > low if right else x >= low
        if i + 1 < len(edges):
            high = F.lit(float(edges[i + 1]))
            inside = inside & (x <= high if right else x < high)
        band = F.when(inside, label) if band is None else band.when(inside, label)
    return band


def comma(c: Column | str) -> Column:
    return F.format_number(col(c), 0)


def dollar(c: Column | str) -> Column:
    return F.concat(F.lit("$"), F.format_number(rounded(c, 2), 2))


def percent(c: Column | str, digits: int = 1) -> Column:
    return F.concat(F.format_number(rounded(col(c) * 100, digits), digits), F.lit("%"))


def to_metrics(df: DataFrame, kind: str = "double") -> DataFrame:
    """One-row table to ``(metric, value)`` rows in column order."""
    typed = df.select(*[F.col(c).cast(kind).alias(c) for c in df.columns])
    return typed.unpivot([], df.columns, "metric", "value")
