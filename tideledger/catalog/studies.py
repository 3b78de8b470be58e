"""Wallet, program and source studies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideledger.catalog.base import (
    ATTRIBUTION, EV, EVENT_FILL, FULL_TWA, SW, Ctx, _day, query, twa_views, with_,
)
from tideledger.catalog.balances import SINGLE
from tideledger.catalog.events import studied
from tideledger.catalog.relational import TRADES, trades
from tideledger.operators import attribution as at, monthly as mo, reconcile as rc, reports as rp
from tideledger.operators.twa import balance_intervals, single_code_daily, to_daily

FILL = _day(EVENT_FILL)
DAY_RATE = "1.0::DOUBLE + CAST(date_part('day', dt) AS DOUBLE) / 1000.0"


def day_rates(c: Ctx):
    """A conversion rate for every day of the event data."""
    days = c.spark.sql(f"select explode(sequence(date'2024-01-01', date'{EVENT_FILL}', interval 1 day)) dt")
    return days.withColumn("rate", F.lit(1.0) + F.dayofmonth("dt").cast("double") / F.lit(1000.0))


def full(c: Ctx):
    return to_daily(c.intervals)


IMPACT = with_(ATTRIBUTION, """legs AS (SELECT s.blockchain, s.contract_address, t.symbol, s.user_addr, s.block_number AS block, s.log_index, s.leg_seq,
    s.block_time AS ts, s.delta AS amount_change, c.ref_code FROM sides s JOIN targets t USING (blockchain, contract_address)
  LEFT JOIN merged c ON c.tx_hash = s.tx_hash AND c.contract_address = s.contract_address AND c.user_addr = s.user_addr)""",
  """base_legs AS (SELECT s.blockchain, s.contract_address, t.symbol, s.user_addr, s.block_number AS block, s.log_index, s.leg_seq,
    s.block_time AS ts, s.delta AS amount_change, c.ref_code FROM sides s JOIN targets t USING (blockchain, contract_address)
  LEFT JOIN real_codes c ON c.tx_hash = s.tx_hash AND c.contract_address = s.contract_address AND c.user_addr = s.user_addr)""",
  twa_views(EVENT_FILL), twa_views(EVENT_FILL, legs="base_legs", p="b_"))


@query("d36_program_impact", IMPACT + """
, a AS (SELECT CAST(date_trunc('month', dt) AS DATE) AS month, ref_code, CAST(sum(prod) AS DOUBLE) / 86400.0 / 365.0 * 0.005 AS dr FROM daily GROUP BY 1, 2),
b AS (SELECT CAST(date_trunc('month', dt) AS DATE) AS month, ref_code, CAST(sum(prod) AS DOUBLE) / 86400.0 / 365.0 * 0.005 AS dr FROM b_daily GROUP BY 1, 2),
d AS (SELECT coalesce(a.month, b.month) AS month, coalesce(a.ref_code, b.ref_code) AS ref_code, coalesce(a.dr, 0.0) AS with_program, coalesce(b.dr, 0.0) AS baseline
  FROM a FULL JOIN b ON a.month = b.month AND a.ref_code = b.ref_code)
SELECT month, ref_code, round(with_program, 4) AS with_program, round(baseline, 4) AS baseline, round(with_program - baseline, 4) AS delta FROM d""")
def d36(c: Ctx):
    def monthly(iv):
        daily = mo.interval_amounts(iv)
        return daily.groupBy(F.trunc("dt", "MM").alias("month"), "ref_code").agg((F.sum("amount") / 365.0 * F.lit(0.005)).alias("dr_usd"))

    d = rc.program_impact(monthly(c.intervals), monthly(balance_intervals(c.plain_legs, FILL)))
    return d.select("month", "ref_code", *[F.round(n, 4).alias(n) for n in ("with_program", "baseline", "delta")])


@query("d36_program_net_zero", IMPACT + """
SELECT CAST(date_trunc('month', dt) AS DATE) AS month, abs(sum(p)) < 0.01 AS nets_to_zero FROM (
  SELECT dt, prod AS p FROM daily UNION ALL SELECT dt, -prod FROM b_daily) GROUP BY 1""")
def d36_zero(c: Ctx):
    def monthly(iv):
        daily = mo.interval_amounts(iv)
        return daily.groupBy(F.trunc("dt", "MM").alias("month"), "ref_code").agg(F.sum("amount").alias("dr_usd"))

    d = rc.program_impact(monthly(c.intervals), monthly(balance_intervals(c.plain_legs, FILL)))
    return d.groupBy("month").agg((F.abs(F.max("month_net")) < 0.01).alias("nets_to_zero"))


@query("d37_zero_code_receivers", with_(EV, SW) + """
, z AS (SELECT *, CASE WHEN receiver IN ('u1', 'u2', 'u5') THEN receiver || ' vault' ELSE 'others' END AS receiver_group FROM sw WHERE ref_code = 0)
SELECT blockchain, receiver_group, count(*) AS swaps, count(DISTINCT receiver) AS wallets, CAST(sum(amount_out) AS BIGINT) AS volume FROM z GROUP BY 1, 2""")
def d37(c: Ctx):
    infra = c.spark.sql("select * from values ('main','u1','u1 vault'), ('main','u2','u2 vault'), ('main','u5','u5 vault') as t(blockchain, address, label)")
    return rp.zero_code_receivers(c.sw, infra).withColumn("swaps", F.col("swaps").cast("bigint"))


@query("d43_wallet_summary", with_(FULL_TWA) + """
SELECT user_addr, ref_code, symbol AS token, contract_address || '_src' AS source, min(dt) AS first_seen, max(dt) AS last_seen, count(DISTINCT dt) AS days_tagged,
  max(twab) AS peak_twa, round(CAST(sum(CAST(twab AS DECIMAL(28,10))) AS DOUBLE), 6) AS total_twa_days
FROM daily WHERE ref_code IN (1003, 1004, 4011, 42) GROUP BY 1, 2, 3, 4""")
def d43(c: Ctx):
    twa = full(c)
    codes = c.spark.sql("select * from values (1003L), (1004L), (4011L), (42L) as t(ref_code)")
    parts = {f"{t}_src": twa.filter(F.col("contract_address") == t) for t in ("tok0", "tok1")}
    return rp.wallet_summary(parts, codes).withColumn("total_twa_days", F.round("total_twa_days", 6))


@query("d44_wallet_audit", SINGLE.rstrip() + """
SELECT s.*, r.total_received FROM (
  SELECT user_addr, count(*) AS days_counted, min(twab) AS min_daily, max(twab) AS max_daily, round(CAST(sum(CAST(twab AS DECIMAL(28,10))) AS DOUBLE), 6) AS balance_days,
    round(CAST(sum(CAST(twab AS DECIMAL(28,10))) AS DOUBLE) / count(*), 6) AS avg_daily
  FROM daily WHERE ref_code = 1004 AND ends_day GROUP BY 1) s
LEFT JOIN (SELECT user_addr, CAST(sum(net) AS BIGINT) AS total_received FROM code_net WHERE user_addr <> 'router' GROUP BY 1) r USING (user_addr)""")
def d44(c: Ctx):
    counted = single_code_daily(balance_intervals(studied(c), FILL, ["blockchain", "contract_address", "user_addr"]), 1004)
    received = at.code_net_recipients(c.rf, c.tr, 1004).filter("user_addr <> 'router'")
    return rp.wallet_audit(counted, received).withColumns({m: F.round(m, 6) for m in ("avg_daily", "balance_days")})


@query("d47_wallet_snapshot", with_(FULL_TWA) + f"""
SELECT symbol AS source, blockchain, user_addr, ref_code, day_type, twab AS twa_shares, twab * ({DAY_RATE}) AS usds_base
FROM daily WHERE dt = DATE '2024-01-14' AND ref_code IN (-999999, 1003, 4011)""")
def d47(c: Ctx):
    twa = full(c)
    parts = {s: twa.filter(F.col("symbol") == s) for s in ("sUSDS", "sUSDC")}
    return rp.wallet_snapshot(parts, "2024-01-14", [-999999, 1003, 4011], day_rates(c))


@query("d48_wallet_history", with_(FULL_TWA) + f"""
SELECT dt, blockchain, symbol AS token, user_addr, ref_code, day_type, twab AS twa_shares, 1.0::DOUBLE AS ratio, {DAY_RATE} AS conversion, twab * 1.0::DOUBLE * ({DAY_RATE}) AS usds_base
FROM daily WHERE dt >= DATE '2024-01-10' AND user_addr IN (SELECT user_addr FROM daily WHERE ref_code = 42 AND dt >= DATE '2024-01-10' AND dt < DATE '2024-01-20')""")
def d48(c: Ctx):
    return rp.wallet_history(full(c), 42, "2024-01-10", "2024-01-20", "2024-01-10", conversion=day_rates(c))


@query("d48_single_wallet", with_(FULL_TWA) + """
SELECT dt, blockchain, symbol AS token, ref_code, twab AS twa_shares, day_type FROM daily WHERE user_addr = 'u9' AND ref_code = 1003""")
def d48_single(c: Ctx):
    return rp.single_wallet(full(c), "u9", 1003)


@query("d49_top_wallets", with_(FULL_TWA) + f"""
SELECT user_addr, ref_code, token, blockchain, round(avg_usds, 6) AS avg_daily_usds, active_days FROM (
  SELECT user_addr, ref_code, symbol AS token, blockchain, CAST(sum(CAST(twab * ({DAY_RATE}) AS DECIMAL(28,10))) AS DOUBLE) / count(*) AS avg_usds, count(DISTINCT dt) AS active_days
FROM daily GROUP BY 1, 2, 3, 4) ORDER BY avg_usds DESC, user_addr, ref_code, token, blockchain LIMIT 300""")
def d49(c: Ctx):
    return rp.top_wallets(full(c), 300, day_rates(c)).select(
        "user_addr", "ref_code", "token", "blockchain", F.round("avg_daily_usds", 6).alias("avg_daily_usds"), "active_days")


@query("d49_top_wallets_of_code", with_(FULL_TWA) + """
SELECT user_addr, round(CAST(sum(twab) AS DOUBLE) / sum(n), 6) AS avg_daily_usds, count(*) AS active_days FROM (
  SELECT user_addr, dt, sum(CAST(twab AS DECIMAL(28,10))) AS twab, count(*) AS n FROM daily WHERE ref_code = 1003 AND dt < DATE '2024-02-01' AND symbol = 'sUSDS' GROUP BY 1, 2)
GROUP BY 1 ORDER BY CAST(sum(twab) AS DOUBLE) / sum(n) DESC, user_addr LIMIT 20""")
def d49_code(c: Ctx):
    twa = full(c).filter("symbol = 'sUSDS'")
    return rp.top_wallets(twa, 20, code=1003, month="2024-01", keys=["user_addr"]).select(
        "user_addr", F.round("avg_daily_usds", 6).alias("avg_daily_usds"), "active_days")


@query("d50_latest_code_examples", with_(EV, SW) + """
, ranked AS (SELECT contract_address, receiver AS user_addr, ref_code % 2 AS code, block_time,
    count(*) OVER w AS n_events, CAST(sum(CASE WHEN ref_code % 2 = 0 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS n_code_events,
    row_number() OVER (PARTITION BY contract_address, receiver ORDER BY block_number DESC, log_index DESC) AS rn FROM sw
  WINDOW w AS (PARTITION BY contract_address, receiver)),
tagged AS (SELECT *, count(*) OVER (PARTITION BY contract_address) AS wallets_tagged,
    row_number() OVER (PARTITION BY contract_address ORDER BY block_time DESC, user_addr) AS ex FROM ranked WHERE rn = 1 AND code = 0)
SELECT contract_address, user_addr, block_time AS became_at, n_events, n_code_events, wallets_tagged, block_time >= 1705000000 AS became_since,
  user_addr IN (SELECT 'u' || s_suppkey FROM supplier) AS is_contract FROM tagged WHERE ex <= 10""")
def d50(c: Ctx):
    events = c.sw.select("blockchain", "contract_address", F.col("receiver").alias("user_addr"), "block_number", "log_index", "block_time",
                         (F.col("ref_code") % 2).alias("ref_code"))
    tokens = c.targets.select("blockchain", "contract_address", "symbol", F.lit("swap").alias("source"))
    contracts = c.table("supplier").select(F.concat(F.lit("u"), F.col("s_suppkey")).alias("address"))
    return rp.latest_code_examples(events, 0, tokens, contracts, "main", 1705000000).drop("blockchain", "symbol", "source")


@query("d51_sample_transactions", with_(EV, SW) + """
SELECT contract_address, tx_hash, block_time, user_addr, amount FROM (
  SELECT contract_address, tx_hash, block_time, receiver AS user_addr, amount_out AS amount,
    row_number() OVER (PARTITION BY contract_address ORDER BY md5(tx_hash || '#3'), tx_hash) AS rn FROM sw WHERE ref_code = 0) WHERE rn <= 10""")
def d51(c: Ctx):
    rows = c.sw.filter("ref_code = 0").select("contract_address", "tx_hash", "block_time", F.col("receiver").alias("user_addr"), F.col("amount_out").alias("amount"))
    return rp.sample_per_group(rows, ["contract_address"], "tx_hash", 10, seed=3)


@query("d52_attribution_universe", with_(EV, TRADES) + """
SELECT 'A_trade' AS defn, month, count(DISTINCT user_addr) AS wallets FROM trades GROUP BY 1, 2
UNION ALL SELECT 'B_deposit_in_trade_tx', month, count(DISTINCT user_addr) FROM deposits WHERE tx_hash IN (SELECT tx_hash FROM trades) GROUP BY 1, 2""")
def d52(c: Ctx):
    return rp.attribution_universe(*trades(c))


@query("d52_owner_concentration", with_(EV, TRADES) + """
SELECT user_addr, count(*) AS n_deposits, CAST(sum(shares) AS BIGINT) AS total_shares FROM deposits WHERE tx_hash IN (SELECT tx_hash FROM trades)
GROUP BY 1 ORDER BY n_deposits DESC, user_addr LIMIT 40""")
def d52_owners(c: Ctx):
    t, d = trades(c)
    return rp.owner_concentration(d, t)


@query("d53_receiver_codes", with_(EV, SW) + """
SELECT ref_code, count(*) AS n_swaps, CAST(sum(amount_out) AS BIGINT) AS out_cumulative, min(block_time) AS first_swap, max(block_time) AS last_swap
FROM sw WHERE receiver = 'u10' GROUP BY 1""")
def d53(c: Ctx):
    return rp.receiver_codes(c.sw, "u10")
