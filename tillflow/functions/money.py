"""Money as exact whole cents inside, double at the edge."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_LIMB_BITS = 24


def to_cents(amount: Column) -> Column:
    """Double amount to whole cents, halves towards plus infinity."""
    return F.floor(amount * 100 + F.lit(0.5)).cast("bigint")


def from_cents(cents: Column) -> Column:
    """Whole cents to a double amount."""
    return cents.cast("double") / F.lit(100.0)


def round_half_up(amount: Column) -> Column:
    """Two-digit rounding with halves towards plus infinity (-2.5 goes to -2)."""
    return from_cents(to_cents(amount))


def sum_cents(cents: Column) -> Column:
    """Exact sum of bigint cents that cannot overflow, as ``decimal(38,0)``.

    Two bigint sums over the upper and lower bits keep the aggregation buffer
    primitive (a sum over decimals runs several times slower), and are put
    together once per group.
    """
    upper = F.sum(F.shiftright(cents, _LIMB_BITS)).cast("decimal(20,0)")
    lower = F.sum(cents.bitwiseAND(F.lit((1 << _LIMB_BITS) - 1))).cast("decimal(20,0)")
    whole = upper * F.lit(1 << _LIMB_BITS).cast("decimal(10,0)") + lower
    return whole.cast("decimal(38,0)")


def sum_amount(amount: Column) -> Column:
    """Exact sum of a double money column, as double. No rows give NULL."""
    return from_cents(sum_cents(to_cents(amount)))


def share_cents(part: Column, whole: Column, total: Column) -> Column:
    """``round(part * total / whole)`` in integers, for amounts of zero or more.

    A zero ``whole`` gives NULL. Small amounts stay in bigint; where the product
    could overflow it is taken in decimal.
    """
    small = F.lit(1 << 30)
    divisor = F.nullif(whole * 2, F.lit(0).cast("bigint"))
    in_bigint = F.call_function("div", part * total * 2 + whole, divisor)
    wide_product = part.cast("decimal(18,0)") * (total * 2).cast("decimal(19,0)")
    in_decimal = F.call_function(
        "div", wide_product + whole.cast("decimal(18,0)"), divisor.cast("decimal(19,0)")
    )
    return F.when((part < small) & (total < small), in_bigint).otherwise(in_decimal)
