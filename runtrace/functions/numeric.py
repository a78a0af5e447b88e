"""Exact means and percentages: the same input gives the same cents in any task order."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,6)"


#: The largest amounts that fixed point and the published type hold; whatever is larger is given as these.
LARGEST_EXACT = Decimal("99999999999999999999.999999")
LARGEST = Decimal("999999999999999999999999999999999999.99")


def bounded(value: Column, kind: str, largest: Decimal) -> Column:
    """A number as a decimal, at most the largest that the type holds; never NULL for a number."""
    limit = F.when(value > 0, F.lit(largest)).when(value < 0, F.lit(largest.copy_negate()))
    return F.coalesce(value.try_cast(kind), limit.cast(kind))


def exact(value: Column) -> Column:
    """A measure as a fixed-point number, so that sums do not depend on the order of rows."""
    return bounded(value, "decimal(26,6)", LARGEST_EXACT)


def _fixed(value: Column) -> Column:
    """The same, but NULL if a number is too large."""
    return value.try_cast("decimal(26,6)")


def _all_fit(value: Column) -> Column:
    return F.count(value) == F.count(_fixed(value))


def total(value: Column) -> Column:
    """The sum of a measure as a double: exact unless a number is too large for fixed point."""
    return F.when(_all_fit(value), F.sum(_fixed(value)).cast("double")).otherwise(F.sum(value.cast("double")))


def _wide(value: Column | int) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast(_WIDE)


def cents(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator rounded half away from zero to two decimals; NULL for an empty denominator."""
    top = _wide(numerator)
    bottom = F.nullif(_wide(denominator), _wide(0))
    hundredths = F.call_function(
        "div", _wide(F.abs(top) * _wide(200) + bottom), _wide(bottom * _wide(2))
    )
    signed = F.when(top < 0, -hundredths).otherwise(hundredths)
    return (signed.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(38,2)")


def mean(value: Column) -> Column:
    """Average of the non-null values in cents; exact unless a number is too large for fixed point.

    The value is cast once: the parts of the aggregate share the expression.
    """
    rough = F.sum(value.cast("double")) / F.count(value)
    large = bounded(F.round(rough, 2), "decimal(38,2)", LARGEST)
    return F.when(_all_fit(value), cents(F.sum(_fixed(value)), F.count(value))).otherwise(large)


def mean_parts(value: Column, name: str) -> list[Column]:
    """What `mean` is made of, as columns that may be added up over disjoint sets of rows."""
    return [
        F.sum(_fixed(value)).alias(f"{name}__sum"),
        F.count(value).alias(f"{name}__n"),
        F.count(_fixed(value)).alias(f"{name}__fit"),
        F.sum(value.cast("double")).alias(f"{name}__rough"),
    ]


def mean_of(name: str) -> Column:
    """The mean from added-up parts."""
    n = F.col(f"{name}__n")
    large = bounded(F.round(F.col(f"{name}__rough") / n, 2), "decimal(38,2)", LARGEST)
    return F.when(n == F.col(f"{name}__fit"), cents(F.col(f"{name}__sum"), n)).otherwise(large)


def percentage(part: Column, whole: Column) -> Column:
    return cents(_wide(part) * F.lit(100), whole)


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator to six decimals, for metrics that are not rounded to cents."""
    bottom = F.nullif(_wide(denominator), _wide(0))
    return (_wide(numerator) / bottom).cast(_WIDE)
