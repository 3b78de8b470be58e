"""Daily amounts, deployment ratios and monthly rewards."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideledger.functions.dates import SECONDS_PER_DAY, days_between, month_start
from tideledger.functions.labels import UNTAGGED
from tideledger.functions.rates import per_day
from tideledger.operators.rates import reward_code, with_daily_rate
from tideledger.operators.twa import FILL_DAY, balance_intervals, positive
from tideledger.sources.registry import CONTRACT_HELD_L2, FULL_RATIO_TOKENS, ZERO_REWARD_TOKENS

AMOUNT_KEYS = ["blockchain", "token", "ref_code"]
Reclass = Callable[[Column, Column, Column, Column], Column]

# Codes that stand for an untagged balance of a vault token.
VAULT_UNTAGGED = {"spUSDC": 131, "spUSDT": 130, "spPYUSD": 132}


# --- code rules: (symbol, code, user, chain) -> code --------------------------

def reclass_none(symbol: Column, code: Column, user: Column, chain: Column) -> Column:
    return code


def reclass_savings(symbol: Column, code: Column, user: Column, chain: Column) -> Column:
    """Untagged sUSDS and sUSDC get their own codes."""
    return (
        F.when((code == UNTAGGED) & (symbol == "sUSDS"), F.lit(99))
        .when((code == UNTAGGED) & (symbol == "sUSDC"), F.lit(127))
        .otherwise(code)
    )


def reclass_l2(contract_held: Mapping[str, Sequence[str]] = CONTRACT_HELD_L2) -> Reclass:
    """Untagged to 99; the default code 0 split by who holds the balance."""

    def rule(symbol: Column, code: Column, user: Column, chain: Column) -> Column:
        held = F.lit(False)
        for name, addresses in contract_held.items():
            held = held | ((chain == name) & F.lower(user).isin(*addresses))
        return (
            F.when(code == UNTAGGED, F.lit(99))
            .when((code == 0) & held, F.lit(10001))
            .when(code == 0, F.lit(10000))
            .otherwise(code)
        )

    return rule


def reclass_vaults(symbol: Column, code: Column, user: Column, chain: Column) -> Column:
    """Untagged vault shares get a code per vault token."""
    out = None
    for token, replacement in VAULT_UNTAGGED.items():
        hit = (symbol == token) & code.isin(UNTAGGED, 127)
        out = F.when(hit, F.lit(replacement)) if out is None else out.when(hit, F.lit(replacement))
    return out.otherwise(code)


def reclass_all_untagged(symbol: Column, code: Column, user: Column, chain: Column) -> Column:
    """Every untagged balance to 99."""
    return F.when(code == UNTAGGED, F.lit(99)).otherwise(code)


def _recode(df: DataFrame, rule: Reclass) -> DataFrame:
    user = F.col("user_addr") if "user_addr" in df.columns else F.lit("")
    new = rule(F.col("symbol"), F.col("ref_code"), user, F.col("blockchain"))
    return df.withColumn("ref_code", new.cast("bigint"))


# --- daily amounts ------------------------------------------------------------

def daily_amounts(twa: DataFrame, rule: Reclass = reclass_none) -> DataFrame:
    """Amount per (dt, chain, token, code) of a daily balance table."""
    kept = _recode(twa.filter(F.col("time_weighted_avg_balance") > 0), rule)
    return kept.groupBy("dt", "blockchain", F.col("symbol").alias("token"), "ref_code").agg(
        F.sum("time_weighted_avg_balance").alias("amount")
    )


def interval_amounts(
    intervals: DataFrame, rule: Reclass = reclass_none, extra_keys: Sequence[str] = ()
) -> DataFrame:
    """The same daily amounts straight from intervals.

    Each interval only adds its balance at its first day and takes it off after
    its last one; the daily amount is the running sum of those changes. So a
    wallet holding for a year is two rows instead of 365, they are combined
    before the shuffle, and the running sum has one row per day and code. The
    sums are exact: integers and decimals stay what they are and floating
    balances are carried as decimals, so nothing is left when a balance leaves.
    """
    keys = [*extra_keys, *AMOUNT_KEYS]
    rows = _recode(positive(intervals), rule)
    seconds = F.when(F.col("day_type") == FILL_DAY, F.col("balance") * SECONDS_PER_DAY).otherwise(F.col("prod"))
    exact = "decimal(38,12)" if dict(intervals.dtypes)["prod"] in ("double", "float") else "decimal(38,0)"
    value = seconds.cast(exact)
    changes = F.array(
        F.struct(F.col("start_dt").alias("dt"), value.alias("delta"), F.lit(1).alias("n")),
        F.struct(F.date_add("end_dt", 1).alias("dt"), (-value).cast(exact).alias("delta"), F.lit(-1).alias("n")),
    )
    changed = (
        rows.withColumnRenamed("symbol", "token").select(*keys, F.explode(changes).alias("c"))
        .groupBy(*keys, "c.dt").agg(F.sum("c.delta").alias("delta"), F.sum("c.n").alias("n"))
    )
    ordered = Window.partitionBy(*keys).orderBy("dt")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    levels = changed.select(
        *keys, "dt", F.sum("delta").over(so_far).alias("level"), F.sum("n").over(so_far).alias("holders"),
        F.date_sub(F.lead("dt").over(ordered), 1).alias("until"),
    ).filter(F.col("holders") > 0)
    return levels.select(
        F.explode(days_between(F.col("dt"), F.col("until"))).alias("dt"), *keys,
        (F.col("level").cast("double") / F.lit(float(SECONDS_PER_DAY))).alias("amount"),
    )


# --- deployment ratio ---------------------------------------------------------

def idle_series(legs: DataFrame, fill_through: date, keys: list[str], covered_seconds: bool = False) -> DataFrame:
    """Daily time-weighted holding of vaults; never trimmed.

    ``covered_seconds`` divides a day by the seconds it covers instead of a full
    day (equal on full days).
    """
    codeless = legs.withColumn("ref_code", F.lit(None).cast("bigint"))
    iv = balance_intervals(codeless, fill_through, keys, fill="always")
    per_day_seconds = F.col("dur") if covered_seconds else F.lit(SECONDS_PER_DAY)
    idle = F.when(F.col("day_type") == FILL_DAY, F.col("balance").cast("double")).otherwise(
        F.col("prod").cast("double") / F.nullif(per_day_seconds, F.lit(0)).cast("double")
    )
    return iv.select(*keys, F.explode(days_between(F.col("start_dt"), F.col("end_dt"))).alias("dt"), idle.alias("idle"))


def vault_totals(amounts: DataFrame) -> DataFrame:
    """Total supply per (chain, vault, day) of daily amounts, without zero-reward tokens."""
    return (
        amounts.filter(~F.col("token").isin(*ZERO_REWARD_TOKENS))
        .groupBy("blockchain", F.col("token").alias("vault_symbol"), "dt")
        .agg(F.sum("amount").alias("vault_total_supply"))
    )


def deployment_ratios(
    totals: DataFrame, idle: DataFrame, full_ratio: Sequence[str] = FULL_RATIO_TOKENS
) -> DataFrame:
    """Share of a vault's supply that is deployed, never below 0.

    Tokens in ``full_ratio`` count as fully deployed; pass none to use the
    measured ratio for all. ``idle``: blockchain, vault_symbol, dt, idle.
    """
    joined = totals.join(idle, ["blockchain", "vault_symbol", "dt"], "left")
    forced = F.col("vault_symbol").isin(*full_ratio) if full_ratio else F.lit(False)
    total = F.col("vault_total_supply")
    resting = F.when(forced, F.lit(0.0)).otherwise(F.coalesce("idle", F.lit(0.0)))
    ratio = (
        F.when(forced, F.lit(1.0))
        .when(total > 0, F.greatest((total - resting) / total, F.lit(0.0)))
        .otherwise(F.lit(0.0))
    )
    return joined.select(
        "blockchain", "vault_symbol", "dt", "vault_total_supply", resting.alias("vault_idle_holdings"),
        (total - resting).alias("vault_deployed"), ratio.alias("deployment_ratio"),
    )


# --- rewards ------------------------------------------------------------------

def with_conversion(daily: DataFrame, conversion: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Add ``conversion`` by day and keys; a missing day counts as 1."""
    if conversion is None:
        return daily.withColumn("conversion", F.lit(1.0))
    looked_up = conversion.select(*keys, F.col("rate").alias("_rate"))
    return daily.join(looked_up, list(keys), "left").withColumn("conversion", F.coalesce("_rate", F.lit(1.0))).drop("_rate")


def with_ratio(daily: DataFrame, ratios: DataFrame) -> DataFrame:
    """Add ``ratio`` by (chain, token, day); a missing day counts as 0."""
    looked_up = ratios.select("blockchain", F.col("vault_symbol").alias("token"), "dt",
                              F.col("deployment_ratio").alias("_ratio"))
    return daily.join(looked_up, ["blockchain", "token", "dt"], "left").withColumn(
        "ratio", F.coalesce("_ratio", F.lit(0.0))
    ).drop("_ratio")


def daily_rewards(
    amounts: DataFrame,
    rates: DataFrame,
    conversion: DataFrame | None = None,
    conversion_keys: Sequence[str] = ("dt",),
    ratios: DataFrame | None = None,
    missing_rate: str = "zero",
) -> DataFrame:
    """Daily amounts priced in USD. ``ratios`` switches on the vault rules."""
    rated = with_daily_rate(amounts.withColumn("reward_code", reward_code(F.col("token"))), rates, missing_rate)
    accrued = per_day(F.col("amount"), F.col("reward_per"))
    if ratios is not None:
        rated = with_ratio(rated, ratios)
        accrued = (
            F.when(F.col("token").isin(*ZERO_REWARD_TOKENS), F.lit(0.0))
            .when(F.col("token").isin(*FULL_RATIO_TOKENS), accrued)
            .otherwise(per_day(F.col("amount") * F.col("ratio"), F.col("reward_per")))
        )
    priced = with_conversion(rated.withColumn("tw_reward", accrued), conversion, conversion_keys)
    return priced.withColumn("tw_reward_usd", F.col("tw_reward") * F.col("conversion"))


def measured_ratio(amounts: DataFrame, idle: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``ratio`` to daily amounts in one pass: a vault's supply is a sum over its codes of the day, beside the row itself.

    The same values as :func:`deployment_ratios` and :func:`with_ratio`, without reading the amounts twice.
    """
    vault = [*keys, "blockchain", "token", "dt"]
    resting = idle.select("blockchain", F.col("vault_symbol").alias("token"), "dt", F.col("idle").alias("_idle"))
    total = F.sum("amount").over(Window.partitionBy(*vault))
    rows = amounts.withColumn("_total", total).join(resting, ["blockchain", "token", "dt"], "left")
    measured = F.greatest((F.col("_total") - F.coalesce("_idle", F.lit(0.0))) / F.col("_total"), F.lit(0.0))
    forced = F.col("token").isin(*FULL_RATIO_TOKENS)
    ratio = F.when(forced, F.lit(1.0)).when(F.col("_total") > 0, measured).otherwise(F.lit(0.0))
    return rows.withColumn("ratio", ratio).drop("_total", "_idle")


def monthly_rewards(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Month sums per (chain, token, code), by further ``keys`` if asked, with the average daily amount."""
    return daily.groupBy(*keys, month_start(F.col("dt")).alias("month"), "blockchain", "token", "ref_code").agg(
        F.sum("tw_reward_usd").alias("dr_usd"), F.avg("amount").alias("avg_twa_balance")
    )
