"""Exact money.

Each amount is rounded half-up to cents once, as decimal text would be.  Sums are exact and
do not depend on the order in which partial results meet.  Amounts below ``SMALL`` are
summed as whole cents in a long, which costs no more than a sum of doubles; the rare larger
ones as decimals.  Both are one sum: nothing is cut off, and a total beyond 36 digits fails.
Amounts that are not finite are null to a sum.  Reports get doubles, as the last step.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType

#: A long holds the cents of 9e10 amounts of this size.
SMALL = 1e6
CENTS = "decimal(38,0)"


def is_finite(value: Column) -> Column:
    """True for numbers; Spark orders NaN above infinity.  Null for null."""
    return F.abs(value) < F.lit(float("inf"))


def rounded(value: Column) -> Column:
    """A double amount on whole cents; null if it is not finite."""
    return F.round(F.when(is_finite(value), value), 2)


def cents_parts(value: Column, kind: DataType) -> list[Column]:
    """What has to be summed, part by part, for the cents of a column of amounts.

    Integers are whole cents already; decimals and doubles are currency units.
    """
    if isinstance(kind, IntegralType):
        return [value.cast("long")]
    if isinstance(kind, DecimalType):
        return [(F.round(value, 2) * 100).cast(CENTS)]
    exact = rounded(value)
    small = F.abs(exact) < SMALL
    return [
        F.when(small, F.floor(exact * 100 + 0.5)),
        F.when(~small, (exact.cast("decimal(38,2)") * 100).cast(CENTS)),
    ]


def cents_total(parts: list[Column]) -> Column:
    """The sums of the parts as one exact number of cents; null over no amount at all."""
    known = [F.coalesce(p.cast(CENTS), F.lit(0).cast(CENTS)) for p in parts]
    total = known[0]
    for part in known[1:]:
        total = (total + part).cast(CENTS)
    return F.when(F.coalesce(*(p.cast(CENTS) for p in parts)).isNotNull(), total)


def from_cents(cents: Column) -> Column:
    """Cents as a double of currency units, the nearest there is."""
    return (cents.cast("decimal(36,0)") / F.lit(100).cast("decimal(3,0)")).cast("double")


def exact_ratio(numerator: Column, denominator: Column, scale: int, shift: int = 0) -> Column:
    """``numerator / denominator * 10^shift`` of whole numbers, rounded half-up to ``scale``.

    Null over zero or null.  The quotient is a decimal, so a tie is a tie.
    """
    divisor = F.nullif(denominator.cast(CENTS), F.lit(0).cast(CENTS))
    # Operands of 20 digits leave 18 places for the quotient, larger ones 6.
    narrow = numerator.cast(CENTS).try_cast("decimal(20,0)") / divisor.try_cast("decimal(20,0)")
    wide = numerator.cast(CENTS) / divisor

    def reported(quotient: Column) -> Column:
        value = F.round(quotient, scale + shift)
        if shift:
            # Moving the point is exact in decimals; the double comes last.
            power = F.lit(Decimal(10) ** shift)
            value = value.cast("decimal(34,4)" if shift < 0 else "decimal(30,8)") * power
        return value.cast("double")

    return F.coalesce(reported(narrow), reported(wide))


def amount(quantity: Column, unit_price: Column) -> Column:
    """Line value in currency units."""
    return quantity * unit_price
