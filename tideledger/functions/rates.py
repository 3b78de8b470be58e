"""Rate formulas."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECONDS_PER_YEAR = 365 * 24 * 60 * 60


def annualised_daily_rate(apy: Column) -> Column:
    """365 * ((1 + apy)^(1/365) - 1) written with exp and ln; zero stays zero.

    ``expm1`` is closer to the real value but differs from the settled numbers
    in the twelfth digit, so the plain form is kept.
    """
    x = apy.cast("double")
    grown = F.lit(365.0) * (F.exp(F.log(F.lit(1.0) + x) / F.lit(365.0)) - F.lit(1.0))
    return F.when(x == 0, F.lit(0.0)).otherwise(grown)


def per_second_to_apy(rate_ray: Column) -> Column:
    """Compounding per-second rate in 1e27 units to a yearly rate."""
    return F.pow(rate_ray.cast("double") / F.lit(1e27), F.lit(float(SECONDS_PER_YEAR))) - F.lit(1.0)


def per_day(amount: Column, reward_per: Column) -> Column:
    """Reward accrued by an amount over one day."""
    return amount / F.lit(365.0) * reward_per
