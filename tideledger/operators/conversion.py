"""Daily conversion series from observed share rates."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, Window, functions as F

from tideledger.functions import wide
from tideledger.functions.dates import day_of, days_between

VAULT = ["blockchain", "contract_address"]


def last_rate_of_day(flows: DataFrame, keys: list[str] = VAULT) -> DataFrame:
    """Assets per share of the last flow of each day (ties by log index)."""
    def value(name: str):
        plain = F.col(name).cast("double")
        return F.coalesce(plain, wide.as_double(wide.carried(F.col(f"{name}_wide")))) if f"{name}_wide" in flows.columns else plain

    rated = flows.filter(value("shares") > 0).select(
        *keys, day_of(F.col("block_time")).alias("dt"), "block_time", "log_index", (value("assets") / value("shares")).alias("rate"),
    )
    latest = (F.col("block_time").cast("decimal(18,0)") * F.lit(Decimal(10**19)) + F.col("log_index")).cast("decimal(38,0)")
    return rated.groupBy(*keys, "dt").agg(F.max_by("rate", latest).alias("rate"))


def filled_series(rates: DataFrame, starts: DataFrame, end: date, keys: list[str] = VAULT) -> DataFrame:
    """A value for every day from each series' ``start_dt`` to ``end``.

    Missing days repeat the last value; days before the first value are 1.0.
    Each stretch between two observed days is one interval, expanded at the end.
    """
    extra = [c for c in starts.columns if c not in keys and c != "start_dt"]
    marks = starts.select(*keys, F.col("start_dt").alias("dt"), F.lit(None).cast("double").alias("rate"))
    inside = rates.join(starts.select(*keys, "start_dt"), keys).filter(
        (F.col("dt") >= F.col("start_dt")) & (F.col("dt") <= F.lit(end))
    )
    points = inside.select(*keys, "dt", "rate").unionByName(marks).groupBy(*keys, "dt").agg(F.max("rate").alias("rate"))
    ordered = Window.partitionBy(*keys).orderBy("dt")
    spans = points.select(
        *keys, "dt", F.coalesce("rate", F.lit(1.0)).alias("rate"),
        F.coalesce(F.date_sub(F.lead("dt").over(ordered), 1), F.lit(end)).alias("until"),
    )
    daily = spans.select(*keys, F.explode(days_between(F.col("dt"), F.col("until"))).alias("dt"), "rate")
    return daily.join(starts.select(*keys, *extra), keys) if extra else daily


def conversion_series(flows: DataFrame, starts: DataFrame, end: date, keys: list[str] = VAULT) -> DataFrame:
    """Flows to the filled daily series."""
    return filled_series(last_rate_of_day(flows, keys), starts, end, keys)


def priced_series(series: DataFrame, prices: DataFrame, priced_token: str = "spETH") -> DataFrame:
    """Unit value in USD: rate, times the day's price for the priced token.

    A day without a price uses the newest price; without any price the rate
    stands alone. ``prices``: dt, price.
    """
    latest = prices.agg(F.max_by("price", "dt").alias("latest_price")).withColumn("token_symbol", F.lit(priced_token))
    day_price = prices.withColumn("token_symbol", F.lit(priced_token)).select("token_symbol", "dt", "price")
    joined = series.join(day_price, ["token_symbol", "dt"], "left").join(latest, "token_symbol", "left")
    price = F.coalesce("price", "latest_price")
    return joined.select(
        *series.columns, price.alias("eth_price"),
        F.when(F.col("token_symbol") == priced_token, F.col("rate") * F.coalesce(price, F.lit(1.0)))
        .otherwise(F.col("rate")).alias("usd_value"),
    )
