"""Column expressions whose null, rounding and time rules the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICRO = 1_000_000


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every floating column, so both mean 'missing'."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[
            F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c)
            for c in df.columns
        ]
    )


def clip(value: Column, low: float | None, high: float | None) -> Column:
    """Bound a value and keep nulls (least/greatest would skip them)."""
    out = value
    if low is not None:
        out = F.when(value < low, F.lit(float(low))).otherwise(out)
    if high is not None:
        out = F.when(value > high, F.lit(float(high))).otherwise(out)
    return out


def half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def fixed_point(value: Column, scale: int = MICRO) -> Column:
    """`value` as whole millionths; sums of these do not depend on row order."""
    return F.round(value * scale).cast("long")


def is_fixed_point(value: Column, scale: int = MICRO) -> Column:
    """Whether `value` is the double next to a whole number of millionths, as recorded decimals are."""
    return (F.abs(value) < F.lit(float(2**53 // scale))) & (F.round(value * scale) / F.lit(float(scale)) == value)


def grid_mean(value: Column, scale: int) -> Column:
    """Mean of the non-null values, each rounded to a grid of 1 / `scale`; for values of a known, small size."""
    total = F.sum(fixed_point(value, scale)).cast("double")
    return F.try_divide(total, F.count(value) * F.lit(float(scale)))


# A double is cut into pieces of 30 bits: whole multiples of these units, from 2**40 down to 2**-110.
_UNITS = [40, 10, -20, -50, -80, -110]


def stable_mean(value: Column, weight: Column | None = None) -> Column:
    """Mean of the non-null values, the same however the rows are partitioned, for values of any size.

    A retried task or another partitioning adds doubles in another order, which can flip the last rounded digit; whole numbers
    cannot differ. Groups of recorded decimals (six places at most) are summed in whole millionths. Other groups are summed without
    error in pieces of 30 bits, each a sum of longs. Where a value lies outside of 2**-57 to 2**70, or a sum outside of a long, the
    mean is the plain one. `weight` is how often a value counts.
    """
    size, sign = F.abs(value), F.signum(value)

    def total(number: Column) -> Column:
        if weight is None:
            return F.try_sum(number).cast("double")
        return F.try_sum(number.cast("decimal(20,0)") * weight.cast("decimal(18,0)")).cast("double")

    known = value.isNotNull()
    rows = F.count(value) if weight is None else F.sum(F.when(known, weight))
    covered = (size == 0) | ((size >= F.lit(2.0**-57)) & (size < F.lit(2.0**70)))
    pieces = []
    for above, unit in zip([None, *_UNITS], _UNITS):
        rest = size if above is None else size % F.lit(2.0**above)
        piece = F.when(known & covered, F.floor(rest / F.lit(2.0**unit)) * sign.cast("int"))
        pieces.append(total(piece) * F.lit(2.0**unit))
    exact = pieces[-1]
    for piece in reversed(pieces[:-1]):
        exact = exact + piece
    as_decimals = total(F.when(is_fixed_point(value), fixed_point(value))) / F.lit(float(MICRO))
    plain = F.sum(value) if weight is None else F.sum(value * weight)
    best = (
        F.when(F.count_if(known & ~is_fixed_point(value)) == 0, as_decimals)
        .when(F.count_if(known & ~covered) == 0, F.coalesce(exact, plain))
        .otherwise(plain)
    )
    return F.try_divide(F.coalesce(best, plain), rows.cast("double"))


def as_timestamp(df: DataFrame, name: str) -> Column:
    """`name` as TIMESTAMP: strings parsed leniently, zone-less values read as UTC."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def moment(as_of: str | None) -> Column:
    """The reference time of a run: an explicit text, or the start of the query."""
    return F.to_timestamp(F.lit(as_of)) if as_of else F.current_timestamp()


def time_text(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
