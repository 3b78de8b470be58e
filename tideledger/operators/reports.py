"""Wallet and source studies over daily balances and events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideledger.operators.monthly import Reclass, daily_amounts, reclass_none, with_conversion, with_ratio


def _exact(value):
    """Ten decimals: sums of them are the same in whatever order rows are met."""
    return value.cast("decimal(28,10)")


def daily_base(
    amounts: DataFrame, conversion: DataFrame | None = None, conversion_keys: Sequence[str] = ("dt",),
    ratios: DataFrame | None = None, by: Sequence[str] = ("dt",), skip_tokens: Sequence[str] = (),
    skip_chains: Sequence[str] = (),
) -> DataFrame:
    """Daily value in USD of daily amounts, in total or by code."""
    kept = amounts
    if skip_tokens:
        kept = kept.filter(~F.col("token").isin(*skip_tokens))
    if skip_chains:
        kept = kept.filter(~F.col("blockchain").isin(*skip_chains))
    priced = with_conversion(kept, conversion, conversion_keys)
    value = F.col("amount") * F.col("conversion")
    if ratios is not None:
        priced = with_ratio(priced, ratios)
        value = F.col("amount") * F.col("ratio") * F.col("conversion")
    return priced.groupBy(*by).agg(F.sum(_exact(value)).cast("double").alias("usds_base"))


def wallet_summary(parts: dict[str, DataFrame], codes: DataFrame | None = None) -> DataFrame:
    """First and last day, days, peak and total per tagged wallet over sources."""
    rows = None
    for name, twa in parts.items():
        part = twa.select(
            F.lit(name).alias("source"), "user_addr", "ref_code", F.col("symbol").alias("token"), "dt",
            "time_weighted_avg_balance",
        )
        rows = part if rows is None else rows.unionByName(part)
    rows = rows.filter(F.col("time_weighted_avg_balance") > 0)
    if codes is not None:
        rows = rows.join(codes.select("ref_code"), "ref_code", "left_semi")
    # Day totals first: the distinct day count then needs no second shuffle of rows.
    keys = ["user_addr", "ref_code", "token", "source"]
    per_day = rows.groupBy(*keys, "dt").agg(
        F.max("time_weighted_avg_balance").alias("peak"), F.sum(_exact(F.col("time_weighted_avg_balance"))).alias("total"))
    return per_day.groupBy(*keys).agg(
        F.min("dt").alias("first_seen"), F.max("dt").alias("last_seen"), F.count("*").alias("days_tagged"),
        F.max("peak").alias("peak_twa"), F.sum("total").cast("double").alias("total_twa_days"),
    )


def wallet_audit(counted: DataFrame, received: DataFrame) -> DataFrame:
    """Balance counted for each wallet against what it received under the code.

    ``counted``: user_addr, dt, twa_balance; ``received``: user_addr, net.
    """
    stats = counted.groupBy("user_addr").agg(
        F.count("*").alias("days_counted"), F.min("twa_balance").alias("min_daily"),
        F.max("twa_balance").alias("max_daily"), F.sum(_exact(F.col("twa_balance"))).cast("double").alias("balance_days"),
    ).withColumn("avg_daily", F.col("balance_days") / F.col("days_counted"))
    got = received.groupBy("user_addr").agg(F.sum("net").alias("total_received"))
    return stats.join(got, "user_addr", "left")


def wallet_snapshot(parts: dict[str, DataFrame], dt: str, codes: Sequence[int], conversion: DataFrame) -> DataFrame:
    """Wallets holding one of the codes on a day, priced with that day's rate."""
    rows = None
    for name, twa in parts.items():
        part = twa.filter((F.col("dt") == F.to_date(F.lit(dt))) & F.col("ref_code").isin(*codes)).select(
            F.lit(name).alias("source"), "blockchain", "user_addr", "ref_code", "dt", "day_type",
            F.col("time_weighted_avg_balance").alias("twa_shares"),
        )
        rows = part if rows is None else rows.unionByName(part)
    priced = with_conversion(rows, conversion, ["dt"])
    return priced.withColumn("usds_base", F.col("twa_shares") * F.col("conversion")).drop("conversion", "dt")


def wallet_history(
    twa: DataFrame, code: int, first: str, until: str, since: str, ratios: DataFrame | None = None,
    conversion: DataFrame | None = None, conversion_keys: Sequence[str] = ("dt",),
) -> DataFrame:
    """Daily rows since a day of every wallet that held the code in [first, until)."""
    held = twa.filter(
        (F.col("ref_code") == code) & (F.col("dt") >= F.to_date(F.lit(first))) & (F.col("dt") < F.to_date(F.lit(until)))
    ).select("user_addr").distinct()
    rows = twa.filter(F.col("dt") >= F.to_date(F.lit(since))).join(held, "user_addr", "left_semi").withColumnRenamed("symbol", "token")
    priced = with_conversion(rows, conversion, conversion_keys)
    priced = with_ratio(priced, ratios) if ratios is not None else priced.withColumn("ratio", F.lit(1.0))
    value = F.col("time_weighted_avg_balance") * F.col("ratio") * F.col("conversion")
    return priced.select("dt", "blockchain", "token", "user_addr", "ref_code", "day_type",
                         F.col("time_weighted_avg_balance").alias("twa_shares"), "ratio", "conversion", value.alias("usds_base"))


def single_wallet(twa: DataFrame, user: str, code: int) -> DataFrame:
    return twa.filter((F.col("user_addr") == user) & (F.col("ref_code") == code)).select(
        "dt", "blockchain", F.col("symbol").alias("token"), "ref_code",
        F.col("time_weighted_avg_balance").alias("twa_shares"), "day_type")


def top_wallets(
    twa: DataFrame, n: int, conversion: DataFrame | None = None, code: int | None = None,
    month: str | None = None, keys: Sequence[str] = ("user_addr", "ref_code", "token", "blockchain"),
) -> DataFrame:
    """Wallets with the highest average daily value (ties by keys)."""
    rows = twa.withColumnRenamed("symbol", "token")
    if code is not None:
        rows = rows.filter(F.col("ref_code") == code)
    if month is not None:
        rows = rows.filter(F.trunc("dt", "MM") == F.to_date(F.lit(f"{month}-01")))
    priced = with_conversion(rows, conversion, ["dt"]).withColumn("usds", F.col("time_weighted_avg_balance") * F.col("conversion"))
    per_day = priced.groupBy(*keys, "dt").agg(F.sum(_exact(F.col("usds"))).alias("day_sum"), F.count("*").alias("rows"), F.max("usds").alias("day_max"))
    stats = per_day.groupBy(*keys).agg(
        (F.sum("day_sum").cast("double") / F.sum("rows")).alias("avg_daily_usds"), F.max("day_max").alias("max_daily_usds"),
        F.sum("day_sum").cast("double").alias("usds_days"), F.count("*").alias("active_days"))
    return stats.orderBy(F.col("avg_daily_usds").desc(), *keys).limit(n)


def latest_code_examples(events: DataFrame, code: int, tokens: DataFrame, contracts: DataFrame,
                         registry_chain: str, since_ts: int, k: int = 10) -> DataFrame:
    """The k latest wallets per source and token whose last event named the code.

    ``events``: blockchain, contract_address, user_addr, block_number, log_index,
    block_time, ref_code. Totals come from a grouping joined back, so a source
    holding most wallets is never gathered in one task; the top k is taken per
    partition before the shuffle.
    """
    keys = ["blockchain", "contract_address", "user_addr"]
    order = F.struct("block_number", "log_index")
    wallets = events.groupBy(*keys).agg(
        F.max_by("ref_code", order).alias("last_code"), F.max_by("block_time", order).alias("became_at"),
        F.count("*").alias("n_events"), F.sum((F.col("ref_code") == code).cast("bigint")).alias("n_code_events"),
    ).filter(F.col("last_code") == code).drop("last_code")
    named = wallets.join(tokens, ["blockchain", "contract_address"])
    totals = named.groupBy("source", "symbol").agg(F.count("*").alias("wallets_tagged"))
    newest = Window.partitionBy("source", "symbol").orderBy(F.col("became_at").desc(), F.col("user_addr"))
    picked = named.withColumn("rn", F.row_number().over(newest)).filter(F.col("rn") <= k).drop("rn")
    known = contracts.select(F.lit(registry_chain).alias("blockchain"), F.col("address").alias("user_addr"), F.lit(True).alias("_known"))
    return (
        picked.join(totals, ["source", "symbol"])
        .join(known, ["blockchain", "user_addr"], "left")
        .withColumn("became_since", F.col("became_at") >= since_ts)
        .withColumn("is_contract", F.when(F.col("blockchain") == registry_chain, F.coalesce("_known", F.lit(False))))
        .drop("_known")
    )


def hash_order(column: Column, seed: int) -> Column:
    """Repeatable random order: the same seed gives the same sample anywhere."""
    return F.md5(F.concat(column, F.lit(f"#{seed}")))


def sample_per_group(df: DataFrame, groups: Sequence[str], id_column: str, n: int, seed: int = 0) -> DataFrame:
    """n repeatable random rows per group."""
    w = Window.partitionBy(*groups).orderBy(hash_order(F.col(id_column), seed), id_column)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def zero_code_receivers(swaps: DataFrame, infra: DataFrame, code: int = 0) -> DataFrame:
    """Swaps that named no code: volume of listed receivers, and of all others together."""
    rows = swaps.filter(F.col("ref_code") == code).join(
        infra.select("blockchain", F.col("address").alias("receiver"), "label"), ["blockchain", "receiver"], "left")
    group = F.coalesce("label", F.lit("others"))
    per_receiver = rows.groupBy("blockchain", group.alias("receiver_group"), "receiver").agg(
        F.count("*").alias("n"), F.sum("amount_out").alias("v"))
    return per_receiver.groupBy("blockchain", "receiver_group").agg(
        F.sum("n").alias("swaps"), F.count("*").alias("wallets"), F.sum("v").alias("volume"))


def receiver_codes(swaps: DataFrame, receiver: str | None = None) -> DataFrame:
    """Code distribution of swaps into one receiver."""
    rows = swaps if receiver is None else swaps.filter(F.col("receiver") == receiver)
    return rows.groupBy("ref_code").agg(
        F.count("*").alias("n_swaps"), F.sum("amount_out").alias("out_cumulative"),
        F.min("block_time").alias("first_swap"), F.max("block_time").alias("last_swap"))


def attribution_universe(trades: DataFrame, deposits: DataFrame) -> DataFrame:
    """Distinct wallets per month under the broad and the strict definition.

    ``trades``/``deposits``: month, tx_hash, user_addr.
    """
    broad = trades.select(F.lit("A_trade").alias("defn"), "month", "user_addr")
    strict = deposits.join(trades.select("tx_hash").distinct(), "tx_hash", "left_semi").select(
        F.lit("B_deposit_in_trade_tx").alias("defn"), "month", "user_addr")
    return broad.unionByName(strict).distinct().groupBy("defn", "month").agg(F.count("*").alias("wallets"))


def owner_concentration(deposits: DataFrame, trades: DataFrame, n: int = 40) -> DataFrame:
    """Largest deposit owners inside trade transactions."""
    inside = deposits.join(trades.select("tx_hash").distinct(), "tx_hash", "left_semi")
    return inside.groupBy("user_addr").agg(F.count("*").alias("n_deposits"), F.sum("shares").alias("total_shares")).orderBy(
        F.col("n_deposits").desc(), "user_addr").limit(n)


def owner_equality(deposits: DataFrame, trades: DataFrame) -> DataFrame:
    """How often the deposit owner is the trade owner of the same transaction."""
    pairs = deposits.select("tx_hash", F.col("user_addr").alias("deposit_owner")).join(
        trades.select("tx_hash", F.col("user_addr").alias("trade_owner")), "tx_hash")
    same = F.when(F.col("deposit_owner") == F.col("trade_owner"), F.lit("owner==trade_owner")).otherwise(F.lit("owner!=trade_owner"))
    per_owner = pairs.groupBy(same.alias("relationship"), "deposit_owner").agg(F.count("*").alias("n"))
    return per_owner.groupBy("relationship").agg(F.sum("n").alias("n_deposits"), F.count("*").alias("distinct_deposit_owners"))


def code_slice(monthly: DataFrame, code: int, skip_chains: Sequence[str] = ()) -> DataFrame:
    """Monthly rows of one code."""
    rows = monthly.filter(F.col("ref_code") == code)
    if skip_chains:
        rows = rows.filter(~F.col("blockchain").isin(*skip_chains))
    return rows.groupBy("month", "blockchain", "token", "ref_code").agg(
        F.sum("dr_usd").alias("dr_usd"), F.avg("avg_twa_balance").alias("avg_twa_balance"))


def ratio_slice(ratios: DataFrame, vault: str, chain: str, since: str) -> DataFrame:
    return ratios.filter((F.col("vault_symbol") == vault) & (F.col("blockchain") == chain) & (F.col("dt") >= F.to_date(F.lit(since)))).select(
        "dt", "vault_total_supply", "vault_idle_holdings", "vault_deployed", "deployment_ratio")


def balances_by_code(twa: DataFrame, rule: Reclass = reclass_none, ratios: DataFrame | None = None) -> DataFrame:
    """Amount per (dt, chain, token, code); with ratios also the deployed amount."""
    amounts = daily_amounts(twa, rule)
    if ratios is None:
        return amounts
    deployed = F.when(F.col("token") == "spETH", F.lit(0.0)).otherwise(F.col("amount") * F.col("ratio"))
    return with_ratio(amounts, ratios).withColumn("amount_deployed", deployed).drop("ratio")


def moving_average(df: DataFrame, value: str, keys: Sequence[str], rows: int = 7) -> DataFrame:
    """Average of the current and the earlier rows by position; floating values are summed as decimals, so no residue of the window's edge is left."""
    w = Window.partitionBy(*keys).orderBy("dt").rowsBetween(-(rows - 1), 0)
    floating = dict(df.dtypes)[value] in ("double", "float")
    average = F.avg(F.col(value).cast("decimal(28,9)")).over(w).cast("double") if floating else F.avg(value).over(w)
    return df.withColumn(f"{value}_{rows}d_avg", average)


def program_month_totals(daily: DataFrame, digits: int = 4) -> DataFrame:
    """Monthly totals of a program per chain and over all chains (``ALL``).

    ``daily``: blockchain, user_addr, dt, twa_usds, dr_usd. Wallets are counted
    once per group.
    """
    per_wallet = daily.groupBy(F.trunc("dt", "MM").alias("month"), "blockchain", "user_addr").agg(
        F.sum("twa_usds").alias("s"), F.count("*").alias("n"), F.sum("dr_usd").alias("d"))
    s, n = F.sum("s"), F.sum("n")
    return per_wallet.groupingSets([["month", "blockchain"], ["month"]], "month", "blockchain").agg(
        F.countDistinct("user_addr").alias("active_wallets"),
        F.round(s / n, digits).alias("avg_daily_twa_usds"), F.round(s, digits).alias("sum_twa_usds"),
        F.round(F.sum("d"), digits).alias("dr_usd"),
    ).withColumn("blockchain", F.coalesce("blockchain", F.lit("ALL")))
