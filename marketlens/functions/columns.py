"""Column helpers shared by the operators."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(value: Column) -> Column:
    """Number, or null when the text is no number (NaN counts as missing)."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def to_timestamp(value: Column) -> Column:
    """Timestamp without zone, or null when the text is none."""
    return value.try_cast("timestamp_ntz")


def known(condition: Column) -> Column:
    """The condition, with unknown counted as false."""
    return F.coalesce(condition, F.lit(False))


def clipped(name: str, length: int) -> Column:
    """Text column cut to ``length`` characters."""
    return F.left(F.col(name).cast("string"), F.lit(length)).alias(name)


def cents(amount: Column) -> Column:
    """The amount as decimal with two places, half away from zero, in whole cents (a long).

    Doubles that are surely nearest to one cent need no decimal; the others, and all large ones, take that way.
    """
    hundredfold = amount * 100.0
    nearest = F.rint(hundredfold)
    sure = (F.abs(amount) < 1e9) & (F.abs(hundredfold - nearest) < 0.4)
    return F.when(sure, nearest.cast("long")).otherwise((amount.cast("decimal(18,2)") * 100).cast("long"))


def money_sum(amount: Column) -> Column:
    """Exact sum of amounts in cents, the same in whatever order rows arrive.

    Partial sums are longs, which take a fifth of a decimal's bytes in a shuffle; a sum beyond 9.2e16 is an error.
    """
    total = F.sum(cents(amount))
    whole = total.cast("decimal(19,0)") * F.lit(Decimal("0.01"))
    return F.when(F.abs(total) < 1 << 53, total / 100.0).otherwise(whole.cast("double"))


def half_up(value: Column, digits: int = 2) -> Column:
    """Decimal rounding, half away from zero."""
    return F.round(value.cast("decimal(18,6)"), digits).cast("double")


def elapsed_seconds(later: Column, earlier: Column) -> Column:
    """Seconds between two timestamps, with fractions, free of time zones."""
    gap = later - earlier
    return (
        F.extract(F.lit("DAY"), gap).cast("double") * 86400.0
        + F.extract(F.lit("HOUR"), gap).cast("double") * 3600.0
        + F.extract(F.lit("MINUTE"), gap).cast("double") * 60.0
        + F.extract(F.lit("SECOND"), gap).cast("double")
    )


def whole_days(later: Column, earlier: Column) -> Column:
    """Full days between two timestamps, cut toward zero."""
    return F.extract(F.lit("DAY"), later - earlier).cast("double")


def floor_days(later: Column, earlier: Column) -> Column:
    """Full days between two timestamps, rounded down."""
    return F.floor(elapsed_seconds(later, earlier) / 86400.0).cast("int")


def haversine_km(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column) -> Column:
    """Great-circle distance in km on a sphere of the mean Earth radius."""
    half_lat = F.radians(lat_b - lat_a) / 2
    half_lng = F.radians(lng_b - lng_a) / 2
    chord = (
        F.pow(F.sin(half_lat), 2)
        + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.pow(F.sin(half_lng), 2)
    )
    # least() skips nulls, so a missing end must be kept null by hand.
    bounded = F.when(chord.isNotNull(), F.least(F.lit(1.0), chord))
    return 2 * 6371.0088 * F.asin(F.sqrt(bounded))
