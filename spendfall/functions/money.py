"""Exact money arithmetic on whole cents and whole share units (1e-12)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendfall.schemas import MONEY, PCT, SHARE

UNITS_PER_ONE = 10**12


def to_cents(amount: Column) -> Column:
    """Decimal(18,2) money as a bigint number of cents."""
    return (amount.cast(MONEY) * F.lit(100)).cast("bigint")


def from_cents(cents: Column) -> Column:
    """Bigint cents as decimal(18,2) money."""
    return (cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(MONEY)


def from_units(units: Column) -> Column:
    """Bigint share units as a decimal(18,12) share."""
    return (units.cast("decimal(18,0)") * F.lit("0.000000000001").cast("decimal(12,12)")).cast(SHARE)


def split_floor(cents: str, units: str) -> str:
    """SQL for floor(cents * units / 10^12), in 64 bits for every decimal(18,2) amount.

    With c = c1*10^6 + c0 and u = u1*10^6 + u0,
    c*u = c1*u1*10^12 + (c1*u0 + c0*u1)*10^6 + c0*u0.
    """
    c1, c0, u1, u0 = f"{cents} div 1000000L", f"{cents} % 1000000L", f"{units} div 1000000L", f"{units} % 1000000L"
    middle = f"(({c1}) * ({u0}) + ({c0}) * ({u1}))"
    low = f"(({middle} % 1000000L) * 1000000L + ({c0}) * ({u0}))"
    return f"(({c1}) * ({u1}) + {middle} div 1000000L + {low} div 1000000000000L)"


def split_remainder(cents: str, units: str) -> str:
    """SQL for (cents * units) mod 10^12, in 64 bits for every decimal(18,2) amount.

    Of c1*10^6*u only (c1*u0 mod 10^6)*10^6 survives the modulus.
    """
    high = f"((({cents} div 1000000L) * ({units} % 1000000L)) % 1000000L)"
    return f"((({cents} % 1000000L) * {units} + {high} * 1000000L) % 1000000000000L)"


def spare_cents(cents: str, remainder_sum: str, missing: str) -> str:
    """SQL for the cents that rounding down leaves over: (sum of remainders + cents * missing) / 10^12.

    ``missing`` is what the shares lack to one, at most 10^6 units, so the product is
    taken in two limbs. Rules are cut to shares of one at most when they are loaded, so
    nothing is ever missing from the cents themselves.
    """
    high = f"(({cents} div 1000000L) * {missing})"
    low = f"(({high} % 1000000L) * 1000000L + ({cents} % 1000000L) * {missing} + {remainder_sum})"
    return f"greatest({high} div 1000000L + {low} div 1000000000000L, 0L)"


def ratio6(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, half up at six places, computed on whole cents.

    NULL where the denominator is zero or NULL.
    """
    top = (F.abs(numerator) * 100).cast("decimal(29,0)")
    bottom = F.abs((denominator * 100).cast("decimal(29,0)"))
    millionths = F.call_function("div", top * F.lit(2_000_000) + bottom, bottom * F.lit(2))
    value = (millionths.cast("decimal(18,0)") * F.lit("0.000001").cast("decimal(6,6)")).cast(PCT)
    negative = (numerator < 0) != (denominator < 0)
    return F.when(denominator != 0, F.when(negative, -value).otherwise(value).cast(PCT))
