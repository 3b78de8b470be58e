"""Daily rewards over several balance sources with labels, averages and prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tideledger.functions.labels import display_symbol, display_token, referral_type
from tideledger.functions.rates import per_day
from tideledger.operators.rates import with_daily_rate
from tideledger.operators.reports import moving_average

# Rate class per token here; tokens outside it earn nothing.
CLASS_TOKENS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("XR-stUSDS", ("stUSDS",)),
    ("XR", ("sUSDS", "USDS-SKY", "USDS-SPK")),
    ("XR*", ("sUSDC", "spUSDC", "spUSDT", "spPYUSD", "spETH")),
)
SHARED_PRICE_TOKENS = ("sUSDS", "sUSDC")  # priced by one series on every chain

COLUMNS = ["dt", "blockchain", "token", "ref_code", "referral_type", "reward_code", "reward_per",
           "amount", "reward_base", "tw_reward", "amount_7d_avg"]


def class_of(token: Column) -> Column:
    out = None
    for code, tokens in CLASS_TOKENS:
        out = F.when(token.isin(*tokens), F.lit(code)) if out is None else out.when(token.isin(*tokens), F.lit(code))
    return out


def source_rewards(balances: DataFrame, rates: DataFrame) -> DataFrame:
    """Rewards per (dt, chain, token, code).

    ``balances``: dt, blockchain, token, ref_code, amount, amount_deployed. Vault
    tokens earn on the deployed amount; ``reward_base`` shows what earned.
    """
    base = F.when(F.col("token").startswith("sp"), F.col("amount_deployed")).otherwise(F.col("amount"))
    keys = ["dt", "blockchain", "token", "ref_code"]
    daily = balances.groupBy(*keys).agg(F.sum("amount").alias("amount"), F.sum(base).alias("reward_base"))
    classed = daily.withColumn("reward_code", class_of(F.col("token"))).filter(F.col("reward_code").isNotNull())
    rated = with_daily_rate(classed, rates, "drop").withColumns({
        "referral_type": referral_type(F.col("token"), F.col("ref_code")),
        "tw_reward": per_day(F.col("reward_base"), F.col("reward_per")),
    })
    averaged = moving_average(rated, "reward_base", ["blockchain", "token", "ref_code"])
    return averaged.withColumnRenamed("reward_base_7d_avg", "amount_7d_avg").select(*COLUMNS)


def treasury_rewards(balances: DataFrame, holders: DataFrame, rates: DataFrame, label: str = "own referrals") -> DataFrame:
    """Rewards of listed treasury holders under their own rate class.

    ``balances``: dt, blockchain, token, user_addr, amount; ``holders``:
    blockchain, user_addr, ref_code, reward_code.
    """
    held = balances.join(holders, ["blockchain", "user_addr"])
    rated = with_daily_rate(held, rates, "drop").withColumns({
        "referral_type": F.lit(label), "reward_base": F.col("amount"),
        "tw_reward": per_day(F.col("amount"), F.col("reward_per")),
    })
    return moving_average(rated, "amount", ["blockchain", "ref_code"]).select(*COLUMNS)


def priced(rows: DataFrame, prices: DataFrame) -> DataFrame:
    """Display names and USD values. ``prices``: dt, blockchain, token_symbol, usd_value.

    The savings tokens take the shared series of any chain; other tokens their
    own chain's; a missing price is 1.
    """
    named = rows.withColumns({"token_symbol": display_symbol(F.col("token")), "token": display_token(F.col("token"))})
    shared = F.col("token_symbol").isin(*SHARED_PRICE_TOKENS)
    keyed = named.withColumns({
        "_symbol": F.when(F.col("token_symbol") == "sUSDC", F.lit("sUSDS")).otherwise(F.col("token_symbol")),
        "_chain": F.when(shared, F.lit("*")).otherwise(F.col("blockchain")),
    })
    any_chain = prices.filter(F.col("token_symbol") == "sUSDS").withColumn("blockchain", F.lit("*"))
    looked_up = prices.unionByName(any_chain).select(
        "dt", F.col("token_symbol").alias("_symbol"), F.col("blockchain").alias("_chain"), "usd_value")
    out = keyed.join(looked_up, ["dt", "_symbol", "_chain"], "left").drop("_symbol", "_chain")
    price = F.coalesce("usd_value", F.lit(1.0))
    return out.withColumns({"price_usd": price, "tw_reward_usd": F.col("tw_reward") * price}).drop("usd_value")


def monthly_export(daily: DataFrame, since: str) -> DataFrame:
    """Month sums with the reward-weighted price."""
    kept = daily.filter((F.col("dt") >= F.to_date(F.lit(since))) & (F.col("token_symbol") != "spETH"))
    return kept.groupBy(
        F.trunc("dt", "MM").alias("dt"), "token_symbol", "token", "blockchain", "referral_type", "ref_code"
    ).agg(
        F.sum("tw_reward").alias("tw_reward"),
        (F.sum(F.col("tw_reward") * F.col("price_usd")) / F.sum("tw_reward")).alias("price_usd"),
        F.sum("tw_reward_usd").alias("tw_reward_usd"),
    )
