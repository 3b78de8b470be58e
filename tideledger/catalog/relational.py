"""J*, A*, W*, T*, U*, G1: the relational building blocks on real event data."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tideledger.catalog.base import (
    EV, LEDGER, NET, PLAIN_LEGS, RATES, REAL, REWARD_CODE, RF, SIDES, SW, TARGETS, TR, VF, Ctx, day, query, with_,
)
from tideledger.functions import dates
from tideledger.functions.labels import code_order
from tideledger.operators import attribution as at, conversion as cv, monthly as mo, rates as rt, reconcile as rc
from tideledger.operators import reports as rp, rollup as ru
from tideledger.operators.twa import running_state, seconds_to_next
from tideledger.sources.registry import REROUTED_CODES

# Net amount per (day, chain, token, code) of the ledger: a small daily table.
FLOWS = LEDGER + f""",
flows AS (SELECT {day('ts')} AS dt, blockchain, symbol AS token, coalesce(ref_code, -999999) AS ref_code,
  CAST(sum(amount_change) AS BIGINT) AS amount FROM legs GROUP BY ALL)"""


def flows(c: Ctx):
    return c.ledger.groupBy(dates.day_of(F.col("ts")).alias("dt"), "blockchain", F.col("symbol").alias("token"),
                            F.coalesce("ref_code", F.lit(-999999)).alias("ref_code")).agg(F.sum("amount_change").alias("amount"))


# --- joins --------------------------------------------------------------------

@query("j1_legs_with_codes", with_(EV, TR, RF, SIDES, REAL) + """
SELECT c.ref_code, count(*) AS legs, CAST(sum(s.delta) AS BIGINT) AS net FROM sides s LEFT JOIN real_codes c
ON c.tx_hash = s.tx_hash AND c.contract_address = s.contract_address AND c.user_addr = s.user_addr GROUP BY 1""")
def j1(c: Ctx):
    codes = at.real_codes(c.rf).select(*at.WALLET_TX, "ref_code")
    return at.wallet_sides(c.tr).join(codes, at.WALLET_TX, "left").groupBy("ref_code").agg(
        F.count("*").alias("legs"), F.sum("delta").alias("net"))


@query("j2_events_with_targets", with_(EV, RF, TARGETS) + "SELECT symbol, ref_code, count(*) AS n FROM rf JOIN targets USING (blockchain, contract_address) GROUP BY ALL")
def j2(c: Ctx):
    return c.rf.join(c.targets, ["blockchain", "contract_address"]).groupBy("symbol", "ref_code").agg(F.count("*").alias("n"))


@query("j3_rate_range_join", with_(FLOWS, RATES) + f"""
SELECT dt, blockchain, token, ref_code, amount, round(reward_per, 12) AS reward_per FROM flows
JOIN rates ON reward_code = {REWARD_CODE.format(t='token')} AND dt BETWEEN start_dt AND end_dt""")
def j3(c: Ctx):
    coded = flows(c).withColumn("reward_code", rt.reward_code(F.col("token")))
    return rt.with_daily_rate(coded, rt.schedule(c.spark), "drop").drop("reward_code").withColumn("reward_per", F.round("reward_per", 12))


SERIES = """series AS (SELECT CAST(date_trunc('day', o_orderdate) AS DATE) + 10592 AS dt,
  1.0::DOUBLE + CAST(sum(o_custkey % 100) AS DOUBLE) / 10000.0 AS rate FROM orders GROUP BY 1 HAVING sum(o_custkey) % 4 <> 0)"""


def series(c: Ctx):
    """A rate per day of the ledger; the days' own sums leave gaps."""
    days = c.table("orders").groupBy(F.date_add(F.to_date("o_orderdate"), 10592).alias("dt")).agg(
        (F.lit(1.0) + F.sum(F.col("o_custkey") % 100).cast("double") / F.lit(10000.0)).alias("rate"), F.sum("o_custkey").alias("keys"))
    return days.filter(F.col("keys") % 4 != 0).drop("keys")


@query("j4_conversion_default_one", with_(FLOWS, SERIES) + """
SELECT f.dt, f.blockchain, f.token, f.ref_code, f.amount, coalesce(s.rate, 1.0) AS conversion FROM flows f LEFT JOIN series s ON s.dt = f.dt""")
def j4(c: Ctx):
    return mo.with_conversion(flows(c), series(c), ["dt"])


RATIOS = """ratios AS (SELECT blockchain, token AS vault_symbol, dt, CAST(abs(sum(amount)) % 1000 AS DOUBLE) / 1000.0 AS deployment_ratio
  FROM flows WHERE token LIKE 'sp%' GROUP BY ALL)"""


def ratios(c: Ctx):
    return flows(c).filter(F.col("token").like("sp%")).groupBy("blockchain", F.col("token").alias("vault_symbol"), "dt").agg(
        ((F.abs(F.sum("amount")) % 1000).cast("double") / F.lit(1000.0)).alias("deployment_ratio"))


@query("j5_ratio_default_zero", with_(FLOWS, RATIOS) + """
SELECT f.dt, f.blockchain, f.token, f.ref_code, f.amount, coalesce(r.deployment_ratio, 0.0) AS ratio FROM flows f
LEFT JOIN ratios r ON r.blockchain = f.blockchain AND r.vault_symbol = f.token AND r.dt = f.dt""")
def j5(c: Ctx):
    return mo.with_ratio(flows(c), ratios(c))


@query("j6_one_row_constant", with_(FLOWS, SERIES) + """
SELECT f.dt, f.blockchain, f.token, f.ref_code, CAST(f.amount AS DOUBLE) * s.rate AS value FROM flows f, (SELECT max(rate) AS rate FROM series) s""")
def j6(c: Ctx):
    highest = series(c).agg(F.max("rate").alias("rate")).scalar()
    return flows(c).select("dt", "blockchain", "token", "ref_code", (F.col("amount").cast("double") * highest).alias("value"))


PRICES = """prices AS (SELECT CAST(date_trunc('day', o_orderdate) AS DATE) + 10592 AS dt, round(max(o_totalprice), 2) AS price
  FROM orders GROUP BY 1 HAVING sum(o_custkey) % 3 <> 0)"""


def prices(c: Ctx):
    # A price feed with gaps, which come from the days' own sums.
    days = c.table("orders").groupBy(F.date_add(F.to_date("o_orderdate"), 10592).alias("dt")).agg(
        F.round(F.max("o_totalprice"), 2).alias("price"), F.sum("o_custkey").alias("keys"))
    return days.filter(F.col("keys") % 3 != 0).drop("keys")


@query("j13_price_fallback", with_(FLOWS, PRICES) + """
SELECT f.dt, f.token AS token_symbol, f.rate,
  CASE WHEN f.token = 'spETH' THEN coalesce(p.price, (SELECT arg_max(price, dt) FROM prices)) END AS eth_price,
  CASE WHEN f.token = 'spETH' THEN f.rate * coalesce(p.price, (SELECT arg_max(price, dt) FROM prices), 1.0) ELSE f.rate END AS usd_value
FROM (SELECT dt, token, CAST(count(*) AS DOUBLE) AS rate FROM flows WHERE token LIKE 'sp%' GROUP BY ALL) f
LEFT JOIN prices p ON p.dt = f.dt AND f.token = 'spETH'""")
def j13(c: Ctx):
    s = flows(c).filter(F.col("token").like("sp%")).groupBy("dt", F.col("token").alias("token_symbol")).agg(F.count("*").cast("double").alias("rate"))
    return cv.priced_series(s, prices(c))


PERIODS = f"""obs AS (SELECT ts, event_id AS seq, 1e27::DOUBLE + (k // 20) * 1e17::DOUBLE AS value FROM (SELECT *, block_time AS ts FROM ev)),
changes AS (SELECT *, {day('ts')} AS dt FROM (SELECT *, lag(value) OVER (ORDER BY ts, seq) AS prev FROM obs) WHERE value <> coalesce(prev, 0)),
periods AS (SELECT pow(value / 1e27::DOUBLE, 31536000) - 1 AS observed_apy, dt AS start_date,
  coalesce(CAST(lead(dt) OVER (ORDER BY ts, seq) - INTERVAL 1 DAY AS DATE), DATE '2030-12-31') AS end_date FROM changes WHERE dt >= DATE '2024-01-03')"""
RULES = """rules AS (SELECT * FROM (VALUES ('SR', true, 0.0), ('SR', false, 0.0), ('AR', true, 0.006), ('AR', false, 0.002), ('AR*', true, 0.002),
  ('AR*', false, NULL), ('BR', true, 0.003), ('BR', false, 0.003)) AS t(reward_code, early, spread)),
rule_periods AS (SELECT * FROM (VALUES (DATE '2024-01-01', DATE '2025-12-31', true), (DATE '2026-01-01', DATE '2030-12-31', false)) AS t(a, b, early))"""


def observations(c: Ctx):
    return c.ev.select(F.col("block_time").alias("ts"), F.col("event_id").alias("seq"),
                       (F.lit(1e27) + F.floor(F.col("k") / 20) * F.lit(1e17)).alias("value"))


def periods(c: Ctx):
    from datetime import date

    return rt.observed_periods(rt.change_points(observations(c)), date(2024, 1, 3))


@query("j14_interval_overlap", with_(EV, PERIODS, RULES) + """
SELECT reward_code, greatest(start_date, a) AS start_dt, least(end_date, b) AS end_dt, count(*) AS n
FROM periods, rule_periods JOIN rules USING (early) WHERE start_date <= b AND end_date >= a
  AND NOT (reward_code = 'AR*' AND greatest(start_date, a) >= DATE '2026-01-01') GROUP BY ALL""")
def j14(c: Ctx):
    return rt.dynamic_rates(periods(c)).groupBy("reward_code", "start_dt", "end_dt").agg(F.count("*").alias("n"))


TRADES = f"""trades AS (SELECT tx_hash, u AS user_addr, CAST(date_trunc('month', {day('block_time')}) AS DATE) AS month FROM ev WHERE event_type = 'purchase'),
deposits AS (SELECT tx_hash, CASE WHEN k % 3 = 0 THEN 'router' ELSE u END AS user_addr, cents * 100 AS shares,
  CAST(date_trunc('month', {day('block_time')}) AS DATE) AS month FROM ev WHERE event_type IN ('purchase', 'signup'))"""


def trades(c: Ctx):
    month = F.trunc(dates.day_of(F.col("block_time")), "MM").alias("month")
    t = c.ev.filter("event_type = 'purchase'").select("tx_hash", F.col("u").alias("user_addr"), month)
    d = c.ev.filter("event_type in ('purchase', 'signup')").select(
        "tx_hash", F.when(F.col("k") % 3 == 0, F.lit("router")).otherwise(F.col("u")).alias("user_addr"),
        (F.col("cents") * 100).alias("shares"), month)
    return t, d


@query("j15_owner_equality", with_(EV, TRADES) + """
SELECT CASE WHEN d.user_addr = t.user_addr THEN 'owner==trade_owner' ELSE 'owner!=trade_owner' END AS relationship,
  count(*) AS n_deposits, count(DISTINCT d.user_addr) AS distinct_deposit_owners FROM deposits d JOIN trades t USING (tx_hash) GROUP BY 1""")
def j15(c: Ctx):
    t, d = trades(c)
    return rp.owner_equality(d, t)


@query("j16_optional_registry", with_(FLOWS) + """
SELECT DISTINCT blockchain, user_addr, CASE WHEN blockchain = 'chain0' THEN s_suppkey IS NOT NULL END AS is_contract
FROM legs LEFT JOIN supplier ON blockchain = 'chain0' AND 'c' || s_suppkey = user_addr""")
def j16(c: Ctx):
    known = c.table("supplier").select(F.lit("chain0").alias("blockchain"), F.concat(F.lit("c"), F.col("s_suppkey")).alias("user_addr"), F.lit(True).alias("hit"))
    wallets = c.ledger.select("blockchain", "user_addr").distinct()
    return wallets.join(known, ["blockchain", "user_addr"], "left").select(
        "blockchain", "user_addr", F.when(F.col("blockchain") == "chain0", F.col("hit").isNotNull()).alias("is_contract"))


# --- aggregates ---------------------------------------------------------------

@query("a1_latest_per_key", with_(EV, RF) + """
SELECT contract_address, owner, arg_max(ref_code, block_number * 1000 + log_index) AS ref_code FROM rf GROUP BY ALL""")
def a1(c: Ctx):
    return c.rf.groupBy("contract_address", "owner").agg(F.max_by("ref_code", F.struct("block_number", "log_index")).alias("ref_code"))


@query("a2_last_rate_of_day", with_(EV, VF) + f"""
SELECT contract_address, {day('block_time')} AS dt, arg_max(CAST(assets AS DOUBLE) / shares, block_time * 10000 + log_index + block_number % 1000 * 0) AS rate
FROM (SELECT *, row_number() OVER (PARTITION BY contract_address, {day('block_time')} ORDER BY block_time DESC, log_index DESC, block_number DESC) AS rn FROM vf WHERE shares > 0)
WHERE rn = 1 GROUP BY ALL""")
def a2(c: Ctx):
    return cv.last_rate_of_day(c.vf).drop("blockchain")


@query("a3_net_changes", with_(EV, TR, SIDES, NET) + "SELECT contract_address, tx_hash, user_addr, net FROM net")
def a3(c: Ctx):
    return at.net_changes(c.tr.withColumn("amount", F.col("amount").cast("decimal(38,0)"))).drop("blockchain").withColumn("net", F.col("net").cast("bigint"))


@query("a4_events_per_owner", with_(EV, RF) + """
SELECT contract_address, owner, count(*) AS n FROM rf WHERE ref_code IN (1004, 4011) GROUP BY ALL HAVING count(*) >= 3""")
def a4(c: Ctx):
    return c.rf.filter(F.col("ref_code").isin(*REROUTED_CODES)).groupBy("contract_address", "owner").agg(
        F.count("*").alias("n")).filter("n >= 3")


@query("a5_daily_amount", with_(FLOWS) + "SELECT * FROM flows")
def a5(c: Ctx):
    return flows(c)


@query("a6_monthly_sum_and_average", with_(FLOWS) + """
SELECT CAST(date_trunc('month', dt) AS DATE) AS month, blockchain, token, ref_code, CAST(sum(amount) AS BIGINT) AS total, avg(amount) AS average FROM flows GROUP BY 1, 2, 3, 4""")
def a6(c: Ctx):
    return flows(c).groupBy(dates.month_start(F.col("dt")).alias("month"), "blockchain", "token", "ref_code").agg(
        F.sum("amount").alias("total"), F.avg("amount").alias("average"))


@query("a8_wallet_statistics", with_(FLOWS) + f"""
SELECT user_addr, min({day('ts')}) AS first_dt, max({day('ts')}) AS last_dt, avg(amount_change) AS average, count(*) AS legs, count(DISTINCT ref_code) AS codes
FROM legs GROUP BY 1""")
def a8(c: Ctx):
    d = dates.day_of(F.col("ts"))
    return c.ledger.groupBy("user_addr").agg(F.min(d).alias("first_dt"), F.max(d).alias("last_dt"), F.avg("amount_change").alias("average"),
                                             F.count("*").alias("legs"), F.countDistinct("ref_code").alias("codes"))


@query("a9_grouping_sets", with_(FLOWS) + """
SELECT CAST(date_trunc('month', dt) AS DATE) AS month, coalesce(blockchain, 'ALL') AS blockchain, CAST(sum(amount) AS BIGINT) AS amount, count(DISTINCT token) AS tokens
FROM flows GROUP BY GROUPING SETS ((date_trunc('month', dt), blockchain), (date_trunc('month', dt)))""")
def a9(c: Ctx):
    m = flows(c).withColumn("month", dates.month_start(F.col("dt")))
    return m.groupingSets([["month", "blockchain"], ["month"]], "month", "blockchain").agg(
        F.sum("amount").alias("amount"), F.countDistinct("token").alias("tokens")).withColumn("blockchain", F.coalesce("blockchain", F.lit("ALL")))


@query("a10_having_net", with_(EV, TR, SIDES) + """
SELECT contract_address, tx_hash, user_addr, CAST(sum(delta) AS BIGINT) AS net FROM sides GROUP BY ALL HAVING abs(sum(delta)) > 1000""")
def a10(c: Ctx):
    return at.net_changes(c.tr).filter(F.abs("net") > 1000).drop("blockchain")


@query("a12_weighted_price", with_(FLOWS, SERIES) + """
SELECT token, round(sum(abs(f.amount) * s.rate) / sum(abs(f.amount)), 9) AS price FROM flows f JOIN series s USING (dt) GROUP BY 1""")
def a12(c: Ctx):
    w = F.abs("amount").cast("double")
    return flows(c).join(series(c), "dt").groupBy("token").agg(F.round(F.sum(w * F.col("rate")) / F.sum(w), 9).alias("price"))


@query("a13_token_list", with_(FLOWS) + "SELECT ref_code, string_agg(DISTINCT token, ', ' ORDER BY token) AS tokens FROM flows WHERE amount <> 0 GROUP BY 1")
def a13(c: Ctx):
    m = flows(c).select("ref_code", "token", F.col("amount").alias("dr_usd"))
    return ru.tokens_by_code(m)


@query("a14_distinct_keys", with_(FLOWS) + f"SELECT DISTINCT user_addr, {day('ts')} AS dt FROM legs")
def a14(c: Ctx):
    return c.ledger.select("user_addr", dates.day_of(F.col("ts")).alias("dt")).distinct()


@query("a15_group_subtotals", with_(FLOWS) + """
SELECT token, ref_code, CAST(sum(amount) AS BIGINT) AS amount, grouping(ref_code) AS is_subtotal FROM flows GROUP BY ROLLUP (token, ref_code) HAVING grouping(token) = 0""")
def a15(c: Ctx):
    return flows(c).rollup("token", "ref_code").agg(F.sum("amount").alias("amount"), F.grouping("ref_code").cast("bigint").alias("is_subtotal"),
                                                    F.grouping("token").alias("all")).filter("all = 0").drop("all")


@query("a16_average_of_sums", with_(FLOWS) + """
SELECT dt, token, total, avg(total) OVER (PARTITION BY token ORDER BY dt ROWS 6 PRECEDING) AS total_7d_avg
FROM (SELECT dt, token, CAST(sum(amount) AS BIGINT) AS total FROM flows GROUP BY ALL)""")
def a16(c: Ctx):
    per_day = flows(c).groupBy("dt", "token").agg(F.sum("amount").alias("total"))
    return rp.moving_average(per_day, "total", ["token"])


# --- windows ------------------------------------------------------------------

RUNNING = f"""running AS (SELECT contract_address, user_addr, block, log_index, leg_seq, ts, {day('ts')} AS dt,
  CAST(sum(amount_change) OVER w AS BIGINT) AS bal, coalesce(last_value(ref_code IGNORE NULLS) OVER w, -999999) AS code FROM legs
  WINDOW w AS (PARTITION BY contract_address, user_addr ORDER BY block, log_index, leg_seq ROWS UNBOUNDED PRECEDING))"""


@query("w1_running_balance", with_(PLAIN_LEGS, RUNNING) + "SELECT contract_address, user_addr, block, log_index, leg_seq, CAST(bal AS DOUBLE) AS running_balance FROM running")
def w1(c: Ctx):
    return running_state(c.plain_legs).select("contract_address", "user_addr", "block", "log_index", "leg_seq", "running_balance")


@query("w2_forward_filled_code", with_(PLAIN_LEGS, RUNNING) + "SELECT contract_address, user_addr, block, log_index, leg_seq, code AS current_ref_code FROM running")
def w2(c: Ctx):
    return running_state(c.plain_legs).select("contract_address", "user_addr", "block", "log_index", "leg_seq", "current_ref_code")


def _day_ends(c: Ctx):
    """End-of-day state per wallet: a partial-aggregated latest value, no sort."""
    rows = running_state(c.plain_legs).withColumn("dt", dates.day_of(F.col("ts")))
    last = F.struct("block", "log_index", "leg_seq")
    return rows.groupBy("contract_address", "user_addr", "dt").agg(
        F.max_by("running_balance", last).alias("end_balance"), F.max_by("current_ref_code", last).alias("end_code"))


DAY_END = """day_end AS (SELECT contract_address, user_addr, dt, CAST(bal AS DOUBLE) AS end_balance, code AS end_code FROM (
  SELECT *, row_number() OVER (PARTITION BY contract_address, user_addr, dt ORDER BY block DESC, log_index DESC, leg_seq DESC) AS rn FROM running) WHERE rn = 1)"""


@query("w3_last_per_day", with_(PLAIN_LEGS, RUNNING, DAY_END) + "SELECT * FROM day_end")
def w3(c: Ctx):
    return _day_ends(c)


@query("w4_previous_day_state", with_(PLAIN_LEGS, RUNNING, DAY_END) + """
SELECT contract_address, user_addr, dt, coalesce(lag(end_balance) OVER w, 0.0) AS start_balance, lag(end_code) OVER w AS start_code
FROM day_end WINDOW w AS (PARTITION BY contract_address, user_addr ORDER BY dt)""")
def w4(c: Ctx):
    w = Window.partitionBy("contract_address", "user_addr").orderBy("dt")
    return _day_ends(c).select("contract_address", "user_addr", "dt", F.coalesce(F.lag("end_balance").over(w), F.lit(0.0)).alias("start_balance"),
                               F.lag("end_code").over(w).alias("start_code"))


@query("w5_seconds_to_next", with_(PLAIN_LEGS) + f"""
SELECT contract_address, user_addr, {day('ts')} AS dt, block, log_index, leg_seq,
  CAST(coalesce(lead(ts) OVER (PARTITION BY contract_address, user_addr, {day('ts')} ORDER BY block, log_index, leg_seq), ts // 86400 * 86400 + 86400) - ts AS BIGINT) AS seconds FROM legs""")
def w5(c: Ctx):
    return seconds_to_next(c.plain_legs).select(
        "contract_address", "user_addr", dates.day_of(F.col("ts")).alias("dt"), "block", "log_index", "leg_seq", "seconds")


@query("w6_forward_filled_calendar", with_(PLAIN_LEGS, RUNNING, DAY_END) + """
SELECT contract_address, user_addr, dt, last_value(end_balance IGNORE NULLS) OVER w AS balance FROM (
  SELECT contract_address, user_addr, CAST(unnest(generate_series(CAST(min(dt) AS TIMESTAMP), TIMESTAMP '2024-02-05', INTERVAL 1 DAY)) AS DATE) AS dt FROM day_end GROUP BY 1, 2)
LEFT JOIN day_end USING (contract_address, user_addr, dt)
WINDOW w AS (PARTITION BY contract_address, user_addr ORDER BY dt ROWS UNBOUNDED PRECEDING)""")
def w6(c: Ctx):
    w = Window.partitionBy("contract_address", "user_addr").orderBy("dt")
    until = F.coalesce(F.date_sub(F.lead("dt").over(w), 1), F.to_date(F.lit("2024-02-05")))
    return _day_ends(c).withColumn("until", until).select(
        "contract_address", "user_addr", F.explode(dates.days_between(F.col("dt"), F.col("until"))).alias("dt"), F.col("end_balance").alias("balance"))


@query("w7_moving_average", with_(FLOWS) + """
SELECT dt, blockchain, token, ref_code, amount, avg(amount) OVER (PARTITION BY blockchain, token, ref_code ORDER BY dt ROWS 6 PRECEDING) AS amount_7d_avg FROM flows""")
def w7(c: Ctx):
    return rp.moving_average(flows(c), "amount", ["blockchain", "token", "ref_code"])


@query("w8_partition_counts", with_(EV, RF) + """
SELECT tx_hash, owner, ref_code, count(*) OVER w AS n_events, CAST(sum(CASE WHEN ref_code % 2 = 0 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS n_even
FROM rf WINDOW w AS (PARTITION BY contract_address, owner)""")
def w8(c: Ctx):
    # Counted with map-side combine and joined back: a busy owner is never gathered in one task.
    totals = c.rf.groupBy("contract_address", "owner").agg(F.count("*").alias("n_events"), F.sum((F.col("ref_code") % 2 == 0).cast("bigint")).alias("n_even"))
    return c.rf.join(totals, ["contract_address", "owner"]).select("tx_hash", "owner", "ref_code", "n_events", "n_even")


@query("w9_change_periods", with_(EV, PERIODS) + "SELECT round(observed_apy, 6) AS observed_apy, start_date, end_date FROM periods")
def w9(c: Ctx):
    return periods(c).withColumn("observed_apy", F.round("observed_apy", 6))


@query("w9_change_periods_of_many_series", with_(EV, f"""obs AS (SELECT token AS series, block_time AS ts, event_id AS seq, 1e27::DOUBLE + (k // 30) * 1e17::DOUBLE AS value FROM ev),
changes AS (SELECT *, {day('ts')} AS dt FROM (SELECT *, lag(value) OVER (PARTITION BY series ORDER BY ts, seq) AS prev FROM obs) WHERE value <> coalesce(prev, 0))""") + """
SELECT series, round(pow(value / 1e27::DOUBLE, 31536000) - 1, 6) AS observed_apy, dt AS start_date,
  coalesce(CAST(lead(dt) OVER (PARTITION BY series ORDER BY ts, seq) - INTERVAL 1 DAY AS DATE), DATE '2030-12-31') AS end_date FROM changes WHERE dt >= DATE '2024-01-03'""")
def w9_series(c: Ctx):
    from datetime import date

    seen = c.ev.select(F.col("token").alias("series"), F.col("block_time").alias("ts"), F.col("event_id").alias("seq"),
                       (F.lit(1e27) + F.floor(F.col("k") / 30) * F.lit(1e17)).alias("value"))
    found = rt.observed_periods(rt.change_points(seen, keys=["series"]), date(2024, 1, 3), keys=["series"])
    return found.withColumn("observed_apy", F.round("observed_apy", 6))


@query("w10_sample_per_group", with_(EV, SW) + """
SELECT asset_out, tx_hash, receiver FROM (SELECT *, row_number() OVER (PARTITION BY asset_out ORDER BY md5(tx_hash || '#7'), tx_hash) AS rn FROM sw) WHERE rn <= 10""")
def w10(c: Ctx):
    return rp.sample_per_group(c.sw, ["asset_out"], "tx_hash", 10, seed=7).select("asset_out", "tx_hash", "receiver")


# --- order, sets, calendar ----------------------------------------------------

@query("t1_ordered_output", with_(FLOWS) + "SELECT * FROM flows ORDER BY dt, blockchain, token, ref_code")
def t1(c: Ctx):
    return flows(c).orderBy("dt", "blockchain", "token", "ref_code")


@query("t2_code_order", """SELECT code, n FROM (SELECT CAST(o_custkey % 50 AS VARCHAR) AS code, count(*) AS n FROM orders GROUP BY 1
UNION ALL SELECT o_orderpriority, count(*) FROM orders GROUP BY 1 UNION ALL SELECT o_orderstatus, count(*) FROM orders GROUP BY 1)""")
def t2(c: Ctx):
    o = c.table("orders")
    codes = o.select((F.col("o_custkey") % 50).cast("string").alias("code")).union(o.select("o_orderpriority")).union(o.select("o_orderstatus"))
    return codes.groupBy("code").agg(F.count("*").alias("n")).orderBy(*code_order(F.col("code")))


@query("t3_global_top", with_(FLOWS) + "SELECT user_addr, CAST(sum(amount_change) AS BIGINT) AS net FROM legs GROUP BY 1 ORDER BY net DESC, user_addr LIMIT 50")
def t3(c: Ctx):
    return c.ledger.groupBy("user_addr").agg(F.sum("amount_change").alias("net")).orderBy(F.col("net").desc(), "user_addr").limit(50)


@query("t4_top_per_group", with_(FLOWS) + """
SELECT symbol, user_addr, net FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY net DESC, user_addr) AS rn
  FROM (SELECT symbol, user_addr, CAST(sum(amount_change) AS BIGINT) AS net FROM legs GROUP BY ALL)) WHERE rn <= 10""")
def t4(c: Ctx):
    net = c.ledger.groupBy("symbol", "user_addr").agg(F.sum("amount_change").alias("net"))
    w = Window.partitionBy("symbol").orderBy(F.col("net").desc(), "user_addr")
    return net.withColumn("rn", F.row_number().over(w)).filter("rn <= 10").drop("rn")


@query("u1_union_of_signs", with_(EV, TR, SIDES) + "SELECT tx_hash, log_index, user_addr, delta FROM sides")
def u1(c: Ctx):
    return at.wallet_sides(c.tr).select("tx_hash", "log_index", "user_addr", "delta")


@query("u2_union_distinct", with_(EV, TR, RF) + "SELECT owner AS user_addr FROM rf UNION SELECT to_addr FROM tr")
def u2(c: Ctx):
    return c.rf.select(F.col("owner").alias("user_addr")).union(c.tr.select("to_addr")).distinct()


@query("u3_set_difference", with_(FLOWS) + """
, v AS (SELECT DISTINCT blockchain, ref_code, token || '@' || dt AS token FROM flows)
SELECT 'new' AS only_in, ref_code, token FROM (SELECT ref_code, token FROM v WHERE blockchain = 'chain0' EXCEPT SELECT ref_code, token FROM v WHERE blockchain = 'chain1')
UNION ALL SELECT 'old', ref_code, token FROM (SELECT ref_code, token FROM v WHERE blockchain = 'chain1' EXCEPT SELECT ref_code, token FROM v WHERE blockchain = 'chain0')""")
def u3(c: Ctx):
    f = flows(c).withColumn("token", F.concat("token", F.lit("@"), F.col("dt").cast("string")))
    return rc.venue_set_diff(f.filter("blockchain = 'chain0'"), f.filter("blockchain = 'chain1'"), [-1])


@query("u4_key_union", with_(FLOWS) + """
, a AS (SELECT token, ref_code, CAST(sum(amount) AS BIGINT) AS amount FROM flows GROUP BY 1, 2 HAVING sum(amount) % 3 <> 0),
b AS (SELECT token, ref_code, count(*) AS amount FROM flows GROUP BY 1, 2 HAVING count(*) % 3 <> 0)
SELECT coalesce(a.token, b.token) AS token, coalesce(a.ref_code, b.ref_code) AS ref_code, coalesce(a.amount, 0) - coalesce(b.amount, 0) AS delta,
  CASE WHEN a.token IS NULL THEN 'theirs' WHEN b.token IS NULL THEN 'ours' ELSE 'both' END AS present_in FROM a FULL JOIN b ON a.token = b.token AND a.ref_code = b.ref_code""")
def u4(c: Ctx):
    # Two sources over all flows; the values themselves decide which keys each of them lacks.
    keys = ["token", "ref_code"]
    f = flows(c).groupBy(*keys).agg(F.sum("amount").alias("total"), F.count("*").alias("n"))
    a = f.filter(F.col("total") % 3 != 0).select(*keys, F.col("total").alias("amount"))
    b = f.filter(F.col("n") % 3 != 0).select(*keys, F.col("n").alias("amount"))
    d = rc.outer_diff(a, b, keys, ["amount"])
    zero = F.lit(0)
    return d.select(*keys, (F.coalesce("amount_ours", zero) - F.coalesce("amount_theirs", zero)).alias("delta"), "present_in")


@query("g1_calendar", with_(FLOWS) + f"""
SELECT dt, count(*) AS wallets FROM (
  SELECT user_addr, CAST(unnest(generate_series(CAST(min({day('ts')}) AS TIMESTAMP), CAST(max({day('ts')}) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS dt FROM legs GROUP BY 1)
GROUP BY 1""")
def g1(c: Ctx):
    d = dates.day_of(F.col("ts"))
    spans = c.ledger.groupBy("user_addr").agg(F.min(d).alias("a"), F.max(d).alias("b"))
    days = spans.select("user_addr", F.explode(dates.days_between(F.col("a"), F.col("b"))).alias("dt"))
    return days.groupBy("dt").agg(F.count("*").alias("wallets"))
