"""Rates, conversion, ratios and rewards."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tideledger.catalog.base import (
    DELIVERY, EV, FULL_TWA, LEDGER, LEDGER_FILL, LEDGER_TWA, MERGED, NET, RATES, REAL, REROUTED, REWARD_CODE, RF, SIDES, TR, Ctx, _day, day,
    legs_view, query, twa_views, with_,
)
from tideledger.catalog.relational import PERIODS, PRICES, RULES, periods, prices
from tideledger.operators import conversion as cv, monthly as mo, program_daily as pd_, rates as rt, reports as rp, rollup as ru
from tideledger.operators.twa import to_daily
from tideledger.plans import settlement as se
from tideledger.sources import driver_tables as dt

FILL = _day(LEDGER_FILL)
SERIES_START = "2024-03-01"


def sum_by(view: str, code: str, name: str = "amounts") -> str:
    return f"""{name} AS (SELECT dt, blockchain, symbol AS token, {code} AS ref_code, CAST(sum(prod) AS DOUBLE) / 86400.0 AS amount
  FROM {view} GROUP BY 1, 2, 3, 4)"""


SAVINGS = "CASE WHEN ref_code = -999999 AND symbol = 'sUSDS' THEN 99 WHEN ref_code = -999999 AND symbol = 'sUSDC' THEN 127 ELSE ref_code END"
VAULT_CODES = """CASE WHEN symbol = 'spUSDC' AND ref_code IN (-999999, 127) THEN 131 WHEN symbol = 'spUSDT' AND ref_code IN (-999999, 127) THEN 130
  WHEN symbol = 'spPYUSD' AND ref_code IN (-999999, 127) THEN 132 ELSE ref_code END"""
L2 = "CASE WHEN ref_code = -999999 THEN 99 WHEN ref_code = 0 AND user_addr IN ('u1', 'u2', 'u4') THEN 10001 WHEN ref_code = 0 THEN 10000 ELSE ref_code END"

SHARE_RATES = f"""last_rate AS (SELECT blockchain, contract_address, symbol AS token, {day('ts')} AS dt, CAST(assets AS DOUBLE) / CAST(shares AS DOUBLE) AS rate FROM (
  SELECT *, abs(amount_change) * (100 + log_index % 7) AS assets, abs(amount_change) * 100 AS shares,
    row_number() OVER (PARTITION BY blockchain, contract_address, {day('ts')} ORDER BY ts DESC, log_index DESC) AS rn
  FROM legs WHERE abs(amount_change) > 0) WHERE rn = 1),
conv AS (SELECT blockchain, token, dt, coalesce(last_value(rate IGNORE NULLS) OVER (PARTITION BY blockchain, token ORDER BY dt ROWS UNBOUNDED PRECEDING), 1.0) AS rate
  FROM (SELECT DISTINCT blockchain, symbol AS token, CAST(unnest(generate_series(TIMESTAMP '{SERIES_START}', TIMESTAMP '{LEDGER_FILL}', INTERVAL 1 DAY)) AS DATE) AS dt FROM legs)
  LEFT JOIN (SELECT blockchain, token, dt, rate FROM last_rate WHERE dt >= DATE '{SERIES_START}') USING (blockchain, token, dt))"""


def share_series(c: Ctx):
    """Conversion per (chain, token, day) of the ledger."""
    starts = c.ledger.select("blockchain", "contract_address", F.col("symbol").alias("token")).distinct().withColumn(
        "start_dt", F.to_date(F.lit(SERIES_START)))
    return cv.conversion_series(dt.share_rates(c.spark, c.sf), starts, FILL).select("blockchain", "token", "dt", "rate")


def savings_amounts(c: Ctx):
    return mo.interval_amounts(c.ledger_intervals, mo.reclass_savings)


@query("d14_conversion_series", with_(LEDGER, SHARE_RATES) + "SELECT blockchain, token, dt, rate FROM conv")
def d14(c: Ctx):
    return share_series(c)


@query("d15_priced_series", with_(LEDGER, SHARE_RATES, PRICES) + """
SELECT v.blockchain, v.token AS token_symbol, v.dt, v.rate, CASE WHEN v.token = 'spETH' THEN coalesce(p.price, (SELECT arg_max(price, dt) FROM prices)) END AS eth_price,
  CASE WHEN v.token = 'spETH' THEN v.rate * coalesce(p.price, (SELECT arg_max(price, dt) FROM prices), 1.0) ELSE v.rate END AS usd_value
FROM conv v LEFT JOIN prices p ON p.dt = v.dt AND v.token = 'spETH'""")
def d15(c: Ctx):
    return cv.priced_series(share_series(c).withColumnRenamed("token", "token_symbol"), prices(c))


IDLE_KEYS = "blockchain, symbol"
IDLE = "idle_legs AS (SELECT * REPLACE (NULL::BIGINT AS ref_code) FROM legs WHERE symbol LIKE 'sp%' AND ref_code IS NULL)"
IDLE_DAILY = IDLE + ",\n" + twa_views(LEDGER_FILL, legs="idle_legs", p="i_", keys=IDLE_KEYS, always=True) + """,
idle AS (SELECT blockchain, symbol AS vault_symbol, dt, CAST(sum(prod) AS DOUBLE) / 86400.0 AS idle FROM i_daily_all GROUP BY ALL)"""


def idle(c: Ctx):
    held = c.ledger.filter(F.col("symbol").startswith("sp") & F.col("ref_code").isNull())
    return mo.idle_series(held, FILL, ["blockchain", "symbol"]).withColumnRenamed("symbol", "vault_symbol")


TOTALS = """totals AS (SELECT blockchain, symbol AS vault_symbol, dt, CAST(sum(prod) AS DOUBLE) / 86400.0 AS total FROM daily
  WHERE symbol LIKE 'sp%' AND symbol <> 'spETH' GROUP BY ALL)"""


def ratio_sql(forced: str) -> str:
    return f"""ratio AS (SELECT t.blockchain, t.vault_symbol, t.dt, t.total AS vault_total_supply,
    CASE WHEN {forced} THEN 0.0 ELSE coalesce(i.idle, 0.0) END AS vault_idle_holdings,
    CASE WHEN {forced} THEN t.total ELSE t.total - coalesce(i.idle, 0.0) END AS vault_deployed,
    CASE WHEN {forced} THEN 1.0 WHEN t.total > 0 THEN greatest((t.total - coalesce(i.idle, 0.0)) / t.total, 0.0) ELSE 0.0 END AS deployment_ratio
  FROM totals t LEFT JOIN idle i ON i.blockchain = t.blockchain AND i.vault_symbol = t.vault_symbol AND i.dt = t.dt)"""


FORCED = "t.vault_symbol IN ('spUSDT', 'spPYUSD')"


def vault_iv(c: Ctx):
    return c.ledger_intervals.filter(F.col("symbol").startswith("sp"))


def vault_supply(c: Ctx):
    """Exact daily supply per vault: codes are merged before the division."""
    one_code = mo.interval_amounts(vault_iv(c), lambda s, code, u, ch: code * 0)
    return mo.vault_totals(one_code)


RATIO_OUT = "SELECT blockchain, vault_symbol, dt, vault_total_supply, vault_idle_holdings, vault_deployed, deployment_ratio FROM ratio"


@query("d17_deployment_ratio", with_(LEDGER_TWA, IDLE_DAILY, TOTALS, ratio_sql(FORCED)) + RATIO_OUT)
def d17(c: Ctx):
    return mo.deployment_ratios(vault_supply(c), idle(c))


@query("d17_deployment_ratio_measured", with_(LEDGER_TWA, IDLE_DAILY, TOTALS, ratio_sql("false")) + RATIO_OUT)
def d17_measured(c: Ctx):
    return mo.deployment_ratios(vault_supply(c), idle(c), ())


@query("d55_ratio_slice", with_(LEDGER_TWA, IDLE_DAILY, TOTALS, ratio_sql("false")) + """
SELECT dt, vault_total_supply, vault_idle_holdings, vault_deployed, deployment_ratio FROM ratio WHERE vault_symbol = 'spPYUSD' AND blockchain = 'chain0' AND dt >= DATE '2026-05-01'""")
def d55(c: Ctx):
    return rp.ratio_slice(mo.deployment_ratios(vault_supply(c), idle(c), ()), "spPYUSD", "chain0", "2026-05-01")


@query("d18_daily_rates", with_(LEDGER, RATES) + f"""
SELECT token, dt, {REWARD_CODE.format(t='token')} AS reward_code, round(reward_per, 12) AS reward_per FROM (
  SELECT DISTINCT symbol AS token, {day('ts')} AS dt FROM legs) JOIN rates ON reward_code = {REWARD_CODE.format(t='token')} AND dt BETWEEN start_dt AND end_dt""")
def d18(c: Ctx):
    from tideledger.functions.dates import day_of

    days = c.ledger.select(F.col("symbol").alias("token"), day_of(F.col("ts")).alias("dt")).distinct()
    coded = days.withColumn("reward_code", rt.reward_code(F.col("token")))
    return rt.with_daily_rate(coded, rt.schedule(c.spark)).withColumn("reward_per", F.round("reward_per", 12))


@query("d19_dynamic_rates", with_(EV, PERIODS, RULES) + """
SELECT reward_code, start_dt, end_dt, round(365.0::DOUBLE * (exp(ln(1.0::DOUBLE + CASE WHEN spread = 0 THEN observed_apy ELSE (1 + observed_apy) * (1 + spread::DOUBLE) - 1 END) / 365.0::DOUBLE) - 1.0::DOUBLE), 6) AS reward_per
FROM (SELECT reward_code, spread, observed_apy, greatest(start_date, a) AS start_dt, least(end_date, b) AS end_dt
  FROM periods, rule_periods JOIN rules USING (early) WHERE start_date <= b AND end_date >= a)
WHERE NOT (reward_code = 'AR*' AND start_dt >= DATE '2026-01-01')""")
def d19(c: Ctx):
    return rt.dynamic_rates(periods(c)).drop("reward_description").withColumn("reward_per", F.round("reward_per", 6))


@query("d20_reclass_savings", with_(FULL_TWA, sum_by("daily", SAVINGS)) + "SELECT * FROM amounts")
def d20_savings(c: Ctx):
    return mo.interval_amounts(c.intervals.transform(_exact), mo.reclass_savings)


def _exact(iv):
    """Event amounts are whole cents: keep them integer for exact sums."""
    return iv.withColumns({"prod": F.col("prod").cast("bigint"), "balance": F.col("balance").cast("bigint")})


@query("d20_reclass_l2", with_(FULL_TWA, sum_by("daily", L2)) + "SELECT * FROM amounts")
def d20_l2(c: Ctx):
    return mo.interval_amounts(_exact(c.intervals), mo.reclass_l2({"main": ("u1", "u2", "u4")}))


@query("d20_reclass_vaults", with_(LEDGER_TWA, sum_by("daily", VAULT_CODES)) + "SELECT * FROM amounts WHERE token LIKE 'sp%'")
def d20_vaults(c: Ctx):
    return mo.interval_amounts(vault_iv(c), mo.reclass_vaults)


@query("d20_reclass_all_untagged", with_(FULL_TWA, sum_by("daily", "CASE WHEN ref_code = -999999 THEN 99 ELSE ref_code END")) + """
SELECT dt, blockchain, token, ref_code, round(amount, 7) AS amount FROM amounts""")
def d20_all(c: Ctx):
    return mo.daily_amounts(to_daily(c.intervals), mo.reclass_all_untagged).withColumn("amount", F.round("amount", 7))


REWARDS = f"""rewards AS (SELECT a.dt, a.blockchain, a.token, a.ref_code, a.amount,
    a.amount / 365.0::DOUBLE * r.reward_per * coalesce(v.rate, 1.0) AS usd
  FROM amounts a JOIN rates r ON r.reward_code = {REWARD_CODE.format(t='a.token')} AND a.dt BETWEEN r.start_dt AND r.end_dt
  LEFT JOIN conv v ON v.blockchain = a.blockchain AND v.token = a.token AND v.dt = a.dt)"""
LEDGER_REWARDS = [LEDGER_TWA, SHARE_RATES, RATES, sum_by("daily", SAVINGS), REWARDS]
MONTHLY_SQL = """monthly AS (SELECT CAST(date_trunc('month', dt) AS DATE) AS month, blockchain, token, ref_code, sum(usd) AS dr_usd, avg(amount) AS avg_twa_balance
  FROM rewards GROUP BY 1, 2, 3, 4)"""


def ledger_daily(c: Ctx):
    return mo.daily_rewards(savings_amounts(c), rt.schedule(c.spark), share_series(c), ["blockchain", "token", "dt"])


def ledger_monthly(c: Ctx):
    return mo.monthly_rewards(ledger_daily(c))


def _rounded(df):
    return df.withColumns({"dr_usd": F.round("dr_usd", 3), "avg_twa_balance": F.round("avg_twa_balance", 2)})


MONTHLY_OUT = "month, blockchain, token, ref_code, round(dr_usd, 3) AS dr_usd, round(avg_twa_balance, 2) AS avg_twa_balance"


@query("d21_monthly_rewards", with_(*LEDGER_REWARDS, MONTHLY_SQL) + f"SELECT {MONTHLY_OUT} FROM monthly")
def d21(c: Ctx):
    return _rounded(ledger_monthly(c))


VAULT_REWARDS = [LEDGER_TWA, SHARE_RATES, RATES, IDLE_DAILY, TOTALS, ratio_sql(FORCED), sum_by("daily", VAULT_CODES), f"""rewards AS (
  SELECT a.dt, a.blockchain, a.token, a.ref_code, a.amount, coalesce(v.rate, 1.0) * CASE WHEN a.token = 'spETH' THEN 0.0
    WHEN a.token IN ('spUSDT', 'spPYUSD') THEN a.amount / 365.0::DOUBLE * r.reward_per
    ELSE a.amount * coalesce(d.deployment_ratio, 0.0) / 365.0::DOUBLE * r.reward_per END AS usd
  FROM amounts a JOIN rates r ON r.reward_code = {REWARD_CODE.format(t='a.token')} AND a.dt BETWEEN r.start_dt AND r.end_dt
  LEFT JOIN ratio d ON d.blockchain = a.blockchain AND d.vault_symbol = a.token AND d.dt = a.dt
  LEFT JOIN conv v ON v.blockchain = a.blockchain AND v.token = a.token AND v.dt = a.dt WHERE a.token LIKE 'sp%')"""]


@query("d21_monthly_rewards_vaults", with_(*VAULT_REWARDS, MONTHLY_SQL) + f"SELECT {MONTHLY_OUT} FROM monthly")
def d21_vaults(c: Ctx):
    return _rounded(mo.monthly_rewards(se.family_daily("sp", vault_iv(c), share_series(c), idle(c))))


FAMILY_TOKENS = {"susds_susdc": ("sUSDS", "sUSDC"), "stusds": ("stUSDS",), "farms": ("USDS-SKY",)}


def family_parts(c: Ctx):
    """Each family's monthly rewards; all but the vaults use the default code rules."""
    shared = share_series(c).filter("blockchain = 'chain0' AND token = 'sUSDS'").select("dt", "rate")
    parts = {}
    for name, tokens in FAMILY_TOKENS.items():
        iv = c.ledger_intervals.filter(F.col("symbol").isin(*tokens))
        parts[name] = mo.monthly_rewards(se.family_daily(name, iv, shared if se.FAMILIES[name].conversion else None))
    parts["sp"] = mo.monthly_rewards(se.family_daily("sp", vault_iv(c), share_series(c), idle(c)))
    return parts


FAMILY_SQL = [*VAULT_REWARDS[:6], sum_by("daily", SAVINGS, "plain"), sum_by("daily", VAULT_CODES), """shared AS (
  SELECT dt, rate FROM conv WHERE blockchain = 'chain0' AND token = 'sUSDS')""", VAULT_REWARDS[-1].replace("rewards AS", "vault_rewards AS"), f"""rewards AS (
  SELECT 'sp' AS source, dt, blockchain, token, ref_code, amount, usd FROM vault_rewards
  UNION ALL
  SELECT CASE WHEN p.token IN ('sUSDS', 'sUSDC') THEN 'susds_susdc' WHEN p.token = 'stUSDS' THEN 'stusds' ELSE 'farms' END, p.dt, p.blockchain, p.token, p.ref_code, p.amount,
    p.amount / 365.0::DOUBLE * r.reward_per * CASE WHEN p.token = 'USDS-SKY' THEN 1.0 ELSE coalesce(s.rate, 1.0) END
  FROM plain p JOIN rates r ON r.reward_code = {REWARD_CODE.format(t='p.token')} AND p.dt BETWEEN r.start_dt AND r.end_dt
  LEFT JOIN shared s ON s.dt = p.dt WHERE p.token NOT LIKE 'sp%')""", """combined AS (SELECT source, CAST(date_trunc('month', dt) AS DATE) AS month, blockchain, token, ref_code,
  sum(usd) AS dr_usd, avg(amount) AS avg_twa_balance FROM rewards GROUP BY 1, 2, 3, 4, 5)"""]


@query("d22_family_rewards", with_(*FAMILY_SQL) + f"SELECT source, {MONTHLY_OUT} FROM combined")
def d22(c: Ctx):
    return _rounded(ru.combine(family_parts(c)))


# --- all families from raw logs, in one scan ------------------------------------

_SETTLE_END, _SETTLE_LAST = date(2025, 12, 16), "2025-12-15"
_CLASS = "['susds_eth','susdc','stusds','usds_farms','susds_psm3','sp_vaults','usds_aave','usds_ref4001'][user_id % 8 + 1]"
_CLASS_EV = EV.replace("'tok' || (user_id % 2) AS token", f"{_CLASS} AS token").replace(
    "OVER (PARTITION BY event_id // 4) AS block_time", f"OVER (PARTITION BY event_id // 4) + {dt.SETTLEMENT_SHIFT_DAYS * 86400} AS block_time")
_NAMED = """targets AS (SELECT * FROM (VALUES ('main', 'susds_eth', 'sUSDS'), ('main', 'susdc', 'sUSDC'), ('main', 'stusds', 'stUSDS'),
  ('main', 'susds_psm3', 'sUSDS'), ('main', 'sp_vaults', 'spUSDC')) AS t(blockchain, contract_address, symbol))"""
_SETTLE_VIEWS = [_CLASS_EV, TR, RF, _NAMED, SIDES, NET, REAL, DELIVERY, REROUTED, MERGED, """codes AS (
  SELECT * FROM merged WHERE contract_address = 'susds_eth' UNION ALL
  SELECT * FROM real_codes WHERE contract_address IN ('susdc', 'stusds', 'sp_vaults') UNION ALL
  SELECT 'main', token, tx_hash, u, first_index + 3, k, 'real' FROM ev WHERE token = 'susds_psm3' AND event_type = 'signup' AND k % 2 = 0 AND k % 10 <> 9)""",
    legs_view("token_legs", "codes"), """legs AS (
  SELECT * FROM token_legs UNION ALL
  SELECT 'main', e.token, 'USDS-SKY', u, e.block_number, first_index, 0, e.block_time, CASE WHEN event_type = 'signup' THEN cents ELSE -(cents // 2) END,
    CASE WHEN event_type = 'signup' THEN k END FROM ev e WHERE token = 'usds_farms' AND event_type IN ('signup', 'error') UNION ALL
  SELECT 'main', token, 'USDS', 'holder', block_number, first_index, 0, block_time, CASE WHEN event_type = 'signup' THEN cents ELSE -(cents // 2) END,
    CASE WHEN token = 'usds_aave' THEN 9001 ELSE 4001 END FROM ev WHERE token LIKE 'usds_%' AND token <> 'usds_farms' AND event_type IN ('signup', 'error'))""",
    """idle_legs AS (SELECT 'main' AS blockchain, 'vault' AS contract_address, 'spUSDC' AS symbol, 'vault' AS user_addr, block_number AS block, first_index AS log_index, 0 AS leg_seq,
  block_time AS ts, CASE WHEN event_type = 'view' THEN cents ELSE -(cents // 2) END AS amount_change, NULL::BIGINT AS ref_code
  FROM ev WHERE token = 'sp_vaults' AND event_type IN ('view', 'error'))""",
    twa_views(_SETTLE_LAST), twa_views(_SETTLE_LAST, legs="idle_legs", p="i_", always=True), RATES, f"""observed AS (
  SELECT token AS series, {day('block_time')} AS dt, arg_max(CAST(cents * (k + 100) AS DOUBLE) / CAST(cents * 100 AS DOUBLE), block_number * 16 + first_index) AS rate
  FROM ev WHERE event_type = 'purchase' AND token IN ('susds_eth', 'stusds', 'sp_vaults') AND cents > 0 GROUP BY ALL)""", f"""conv AS (
  SELECT series, dt, coalesce(last_value(rate IGNORE NULLS) OVER (PARTITION BY series ORDER BY dt ROWS UNBOUNDED PRECEDING), 1.0) AS rate
  FROM (SELECT series, CAST(unnest(generate_series(TIMESTAMP '2025-10-02', TIMESTAMP '{_SETTLE_LAST}', INTERVAL 1 DAY)) AS DATE) AS dt FROM (VALUES ('susds_eth'), ('stusds'), ('sp_vaults')) AS s(series))
  LEFT JOIN observed USING (series, dt))""", """amounts AS (
  SELECT family, dt, blockchain, token, ref_code, sum(prod) / 86400.0::DOUBLE * CASE WHEN token = 'spUSDC' THEN 1.048576::DOUBLE ELSE 1.152921504606846976::DOUBLE END AS amount FROM (
    SELECT CASE contract_address WHEN 'susds_eth' THEN 'susds_susdc' WHEN 'susdc' THEN 'susds_susdc' WHEN 'usds_farms' THEN 'farms' WHEN 'susds_psm3' THEN 'psm3'
        WHEN 'sp_vaults' THEN 'sp' ELSE contract_address END AS family, dt, CASE contract_address WHEN 'susds_psm3' THEN 'base' ELSE 'ethereum' END AS blockchain, symbol AS token,
      CASE WHEN contract_address IN ('susds_eth', 'susds_psm3') AND ref_code = -999999 THEN 99 WHEN contract_address = 'susdc' AND ref_code = -999999 THEN 127
        WHEN contract_address = 'susds_psm3' AND ref_code = 0 THEN 10000 WHEN contract_address = 'sp_vaults' AND ref_code IN (-999999, 127) THEN 131 ELSE ref_code END AS ref_code,
      CAST(prod AS DOUBLE) AS prod FROM daily) GROUP BY family, dt, blockchain, token, ref_code)""",
    """idle AS (SELECT dt, sum(prod) / 86400.0::DOUBLE * 1.048576::DOUBLE AS idle FROM i_daily_all GROUP BY dt)""",
    """supply AS (SELECT dt, sum(amount) AS total FROM amounts WHERE family = 'sp' GROUP BY dt)""", f"""rewards AS (
  SELECT a.*, a.amount * CASE WHEN family = 'sp' THEN greatest((s.total - coalesce(i.idle, 0.0)) / s.total, 0.0) ELSE 1.0 END / 365.0::DOUBLE * r.reward_per * coalesce(c.rate, 1.0) AS usd
  FROM amounts a JOIN rates r ON r.reward_code = {REWARD_CODE.format(t='a.token')} AND a.dt BETWEEN r.start_dt AND r.end_dt
  LEFT JOIN supply s ON s.dt = a.dt LEFT JOIN idle i ON i.dt = a.dt
  LEFT JOIN conv c ON c.dt = a.dt AND c.series = CASE family WHEN 'susds_susdc' THEN 'susds_eth' WHEN 'psm3' THEN 'susds_eth' WHEN 'stusds' THEN 'stusds' WHEN 'sp' THEN 'sp_vaults' END)"""]
SETTLE_OUT = """SELECT family AS source, CAST(date_trunc('month', dt) AS DATE) AS month, blockchain, token, ref_code, round(sum(usd), 6) AS dr_usd, round(avg(amount), 2) AS avg_twa_balance
FROM rewards GROUP BY ALL"""


def _exact_months(df):
    return df.withColumns({"dr_usd": F.round("dr_usd", 6), "avg_twa_balance": F.round("avg_twa_balance", 2)})


@query("d22_settle_logs", with_(*_SETTLE_VIEWS) + SETTLE_OUT)
def d22_settle(c: Ctx):
    return _exact_months(se.settle(dt.settlement_logs(c.ev), _SETTLE_END))


# --- daily base and balances by code ------------------------------------------

def _cents(name: str):
    """Half a cent goes up, also where the noise of a sum leaves it just below."""
    return F.round(F.col(name) + 0.0001, 2).alias(name)


def _base_in_cents(df):
    return df.withColumn("usds_base", _cents("usds_base"))


@query("d45_daily_base", with_(*LEDGER_REWARDS) + """
SELECT a.dt, round(CAST(sum(CAST(a.amount * coalesce(v.rate, 1.0) AS DECIMAL(28,10))) AS DOUBLE) + 0.0001, 2) AS usds_base FROM amounts a
LEFT JOIN conv v ON v.blockchain = a.blockchain AND v.token = a.token AND v.dt = a.dt WHERE a.blockchain <> 'chain2' GROUP BY 1""")
def d45(c: Ctx):
    return rp.daily_base(savings_amounts(c), share_series(c), ["blockchain", "token", "dt"], skip_chains=["chain2"]).transform(_base_in_cents)


@query("d45_daily_base_vaults", with_(*VAULT_REWARDS[:7]) + """
SELECT a.dt, round(CAST(sum(CAST(a.amount * coalesce(d.deployment_ratio, 0.0) * coalesce(v.rate, 1.0) AS DECIMAL(28,10))) AS DOUBLE) + 0.0001, 2) AS usds_base FROM amounts a
LEFT JOIN conv v ON v.blockchain = a.blockchain AND v.token = a.token AND v.dt = a.dt
LEFT JOIN ratio d ON d.blockchain = a.blockchain AND d.vault_symbol = a.token AND d.dt = a.dt WHERE a.token LIKE 'sp%' AND a.token <> 'spETH' GROUP BY 1""")
def d45_vaults(c: Ctx):
    amounts = mo.interval_amounts(vault_iv(c), mo.reclass_vaults)
    ratios = mo.deployment_ratios(vault_supply(c), idle(c))
    return rp.daily_base(amounts, share_series(c), ["blockchain", "token", "dt"], ratios, skip_tokens=["spETH"]).transform(_base_in_cents)


@query("d46_daily_base_by_code", with_(*LEDGER_REWARDS) + """
SELECT a.dt, a.token, a.ref_code, round(CAST(sum(CAST(a.amount * coalesce(v.rate, 1.0) AS DECIMAL(28,10))) AS DOUBLE) + 0.0001, 2) AS usds_base FROM amounts a
LEFT JOIN conv v ON v.blockchain = a.blockchain AND v.token = a.token AND v.dt = a.dt GROUP BY 1, 2, 3""")
def d46(c: Ctx):
    return rp.daily_base(savings_amounts(c), share_series(c), ["blockchain", "token", "dt"], by=["dt", "token", "ref_code"]).transform(_base_in_cents)


@query("d54_code_slice", with_(*LEDGER_REWARDS, MONTHLY_SQL) + f"SELECT {MONTHLY_OUT} FROM monthly WHERE ref_code = 2 AND blockchain <> 'chain1'")
def d54(c: Ctx):
    return _rounded(rp.code_slice(ledger_monthly(c), 2, ["chain1"]))


@query("d56_balances_by_code", with_(FULL_TWA, sum_by("daily", SAVINGS)) + "SELECT dt, blockchain, token, ref_code, round(amount, 7) AS amount FROM amounts")
def d56(c: Ctx):
    return rp.balances_by_code(to_daily(c.intervals), mo.reclass_savings).withColumn("amount", F.round("amount", 7))


@query("d56_balances_deployed", with_(LEDGER_TWA, IDLE_DAILY, TOTALS, ratio_sql("false"), sum_by("daily", "ref_code")) + """
SELECT a.dt, a.blockchain, a.token, a.ref_code, a.amount, round(CASE WHEN a.token = 'spETH' THEN 0.0 ELSE a.amount * coalesce(d.deployment_ratio, 0.0) END, 2) AS amount_deployed
FROM amounts a LEFT JOIN ratio d ON d.blockchain = a.blockchain AND d.vault_symbol = a.token AND d.dt = a.dt WHERE a.token LIKE 'sp%'""")
def d56_deployed(c: Ctx):
    amounts = mo.interval_amounts(vault_iv(c))
    ratios = mo.deployment_ratios(vault_supply(c), idle(c), ())
    deployed = F.when(F.col("token") == "spETH", F.lit(0.0)).otherwise(F.col("amount") * F.col("ratio"))
    return mo.with_ratio(amounts, ratios).withColumn("amount_deployed", F.round(deployed, 2)).drop("ratio")


_SUBSIDISED = """subsidised AS (SELECT 'AR' AS reward_code, CAST(day AS DATE) AS start_dt, CAST(day + INTERVAL 4 DAY AS DATE) AS end_dt, n / 1000.0::DOUBLE AS reward_per FROM (
  SELECT date_trunc('week', ts) AS day, count(*) AS n FROM events GROUP BY 1))"""


@query("d19_full_schedule", with_(EV, PERIODS, RULES, RATES, _SUBSIDISED, """every AS (
  SELECT 2 AS priority, reward_code, greatest(start_date, a) AS start_dt, least(end_date, b) AS end_dt,
    365.0::DOUBLE * (exp(ln(1.0::DOUBLE + CASE WHEN spread = 0 THEN observed_apy ELSE (1 + observed_apy) * (1 + spread::DOUBLE) - 1 END) / 365.0::DOUBLE) - 1.0::DOUBLE) AS reward_per
  FROM periods, rule_periods JOIN rules USING (early) WHERE start_date <= b AND end_date >= a AND greatest(start_date, a) <= least(end_date, b)
    AND NOT (reward_code = 'AR*' AND greatest(start_date, a) >= DATE '2026-01-01')
  UNION ALL SELECT 1, reward_code, start_dt, end_dt, reward_per FROM rates
  UNION ALL SELECT 3, reward_code, start_dt, end_dt, reward_per FROM subsidised)""") + """
SELECT reward_code, dt, round(arg_max(reward_per, priority * 10000000 + (start_dt - DATE '1970-01-01')), 6) AS reward_per FROM every,
  (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2026-12-31', INTERVAL 1 DAY)) AS DATE) AS dt) WHERE dt BETWEEN start_dt AND end_dt GROUP BY 1, 2""")
def d19_full(c: Ctx):
    from tideledger.functions.dates import days_between

    # Weekly campaigns subsidise one class from Monday to Friday.
    week = F.date_trunc("week", F.col("ts").cast("timestamp")).cast("date")
    campaigns = c.table("events").groupBy(week.alias("start_dt")).agg((F.count("*") / F.lit(1000.0)).alias("reward_per")).select(
        F.lit("AR").alias("reward_code"), F.lit("campaign").alias("reward_description"), "start_dt", F.date_add("start_dt", 4).alias("end_dt"), "reward_per")
    lo, hi = F.lit(date(2024, 1, 1)), F.lit(date(2026, 12, 31))
    inside = days_between(F.greatest("start_dt", lo), F.least("end_dt", hi))
    return rt.full_schedule(c.spark, periods(c), campaigns).select("reward_code", F.explode(inside).alias("dt"), F.round("reward_per", 6).alias("reward_per"))


# --- daily rewards over all sources -------------------------------------------

CLASS = """CASE WHEN {t} = 'stUSDS' THEN 'XR-stUSDS' WHEN {t} IN ('sUSDS', 'USDS-SKY', 'USDS-SPK') THEN 'XR' WHEN {t} IN ('sUSDC', 'spUSDC', 'spUSDT', 'spPYUSD', 'spETH') THEN 'XR*' END"""
DAILY_REWARDS = [LEDGER_TWA, SHARE_RATES, RATES, IDLE_DAILY, TOTALS, ratio_sql("false"), sum_by("daily", SAVINGS), f"""based AS (
  SELECT a.*, CASE WHEN a.token = 'spETH' THEN 0.0 WHEN a.token LIKE 'sp%' THEN a.amount * coalesce(d.deployment_ratio, 0.0) ELSE a.amount END AS reward_base
  FROM amounts a LEFT JOIN ratio d ON d.blockchain = a.blockchain AND d.vault_symbol = a.token AND d.dt = a.dt),
user_level AS (SELECT b.*, r.reward_code, r.reward_per, b.reward_base / 365.0::DOUBLE * r.reward_per AS tw_reward,
    CASE WHEN token IN ('sUSDC', 'spUSDC', 'spUSDT', 'spPYUSD') THEN 'own referrals' WHEN token = 'spETH' THEN 'partner referrals'
      WHEN ref_code BETWEEN 100 AND 999 THEN 'own referrals' ELSE 'partner referrals' END AS referral_type,
    avg(reward_base) OVER (PARTITION BY blockchain, token, ref_code ORDER BY dt ROWS 6 PRECEDING) AS amount_7d_avg
  FROM based b JOIN rates r ON r.reward_code = {CLASS.format(t='b.token')} AND b.dt BETWEEN r.start_dt AND r.end_dt),
final AS (SELECT u.dt, u.blockchain, CASE WHEN u.token IN ('USDS-SPK', 'USDS-SKY') THEN 'stakedUSDS' ELSE u.token END AS token_symbol, u.token, u.ref_code, u.referral_type,
    u.reward_code, u.amount, u.reward_base, u.amount_7d_avg, u.tw_reward, coalesce(p.usd_value, 1.0) AS price_usd
  FROM user_level u LEFT JOIN (
    SELECT dt, blockchain, token AS token_symbol, rate AS usd_value FROM conv UNION ALL SELECT dt, '*', token, rate FROM conv WHERE blockchain = 'chain0' AND token = 'sUSDS') p
  ON p.dt = u.dt AND p.token_symbol = CASE WHEN u.token = 'sUSDC' THEN 'sUSDS' WHEN u.token IN ('USDS-SPK', 'USDS-SKY') THEN 'stakedUSDS' ELSE u.token END
    AND p.blockchain = CASE WHEN u.token IN ('sUSDS', 'sUSDC') THEN '*' ELSE u.blockchain END)"""]


def program_rows(c: Ctx):
    amounts = savings_amounts(c)
    ratios = mo.deployment_ratios(vault_supply(c), idle(c), ())
    deployed = F.when(F.col("token") == "spETH", F.lit(0.0)).otherwise(F.col("amount") * F.col("ratio"))
    balances = mo.with_ratio(amounts, ratios).withColumn("amount_deployed", deployed)
    series = share_series(c).select("dt", "blockchain", F.col("token").alias("token_symbol"), F.col("rate").alias("usd_value"))
    # One savings price for every chain: the series of the main chain.
    one = series.filter("token_symbol <> 'sUSDS' OR blockchain = 'chain0'")
    return pd_.priced(pd_.source_rewards(balances, rt.schedule(c.spark)), one)


@query("d38_daily_rewards", with_(*DAILY_REWARDS) + """
SELECT dt, blockchain, token_symbol, token, ref_code, referral_type, reward_code, amount, reward_base, round(amount_7d_avg + 0.0001, 2) AS amount_7d_avg,
  round(tw_reward, 2) AS tw_reward, price_usd, round(tw_reward * price_usd, 2) AS tw_reward_usd FROM final""")
def d38(c: Ctx):
    return program_rows(c).withColumn("amount_7d_avg", _cents("amount_7d_avg")).drop("reward_per").withColumns({
        "tw_reward": F.round("tw_reward", 2), "tw_reward_usd": F.round("tw_reward_usd", 2)})


@query("d38_monthly_export", with_(*DAILY_REWARDS) + """
SELECT CAST(date_trunc('month', dt) AS DATE) AS dt, token_symbol, token, blockchain, referral_type, ref_code, round(sum(tw_reward), 1) AS tw_reward,
  round(sum(tw_reward * price_usd) / sum(tw_reward), 7) AS price_usd, round(sum(tw_reward * price_usd), 1) AS tw_reward_usd
FROM final WHERE dt >= DATE '2025-07-01' AND token_symbol <> 'spETH' GROUP BY 1, 2, 3, 4, 5, 6 HAVING sum(tw_reward) > 0""")
def d38_export(c: Ctx):
    out = pd_.monthly_export(program_rows(c), "2025-07-01").filter("tw_reward > 0")
    return out.withColumns({"tw_reward": F.round("tw_reward", 1), "price_usd": F.round("price_usd", 7), "tw_reward_usd": F.round("tw_reward_usd", 1)})


@query("d38_treasury_rewards", with_(LEDGER_TWA, RATES, """s AS (SELECT d.dt, d.blockchain, CAST(sum(d.prod) AS DOUBLE) / 86400.0 AS amount FROM daily d
  JOIN (SELECT DISTINCT 'c' || c_custkey AS user_addr, 'chain' || (c_nationkey % 3) AS blockchain FROM customer) h USING (blockchain, user_addr)
  WHERE d.ends_day GROUP BY ALL)""") + """
SELECT s.dt, s.blockchain, s.amount, round(s.amount / 365.0::DOUBLE * r.reward_per, 1) AS tw_reward,
  round(CAST(avg(CAST(s.amount AS DECIMAL(28,9))) OVER (PARTITION BY s.blockchain ORDER BY s.dt ROWS 6 PRECEDING) AS DOUBLE) + 0.0001, 0) AS amount_7d_avg
FROM s JOIN rates r ON r.reward_code = 'XR' AND s.dt BETWEEN r.start_dt AND r.end_dt""")
def d38_treasury(c: Ctx):
    cust = c.table("customer").select(
        F.concat(F.lit("c"), F.col("c_custkey")).alias("user_addr"), F.concat(F.lit("chain"), F.col("c_nationkey") % 3).alias("blockchain"))
    iv = c.ledger_intervals.filter("ends_day").join(cust, ["blockchain", "user_addr"], "left_semi")
    # The treasury of a chain is the sum of its wallets, one holder per chain.
    held = mo.interval_amounts(iv.withColumn("symbol", F.lit("USDS")), lambda s, code, u, ch: code * 0)
    balances = held.select("dt", "blockchain", "token", F.lit("treasury").alias("user_addr"), "amount")
    holders = c.spark.sql("select * from values ('chain0','treasury',126L,'XR'), ('chain1','treasury',126L,'XR'), ('chain2','treasury',126L,'XR') as t(blockchain,user_addr,ref_code,reward_code)")
    out = pd_.treasury_rewards(balances, holders, rt.schedule(c.spark))
    return out.select("dt", "blockchain", "amount", F.round("tw_reward", 1).alias("tw_reward"),
                      F.round(F.col("amount_7d_avg") + 0.0001, 0).alias("amount_7d_avg"))  # sums near 10^10: cents are beyond a double
