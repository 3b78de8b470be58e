"""Time-weighted balances."""

from __future__ import annotations

import uuid
from datetime import date
from decimal import Decimal
from functools import reduce

from pyspark.sql import functions as F

from tideledger.catalog.base import (
    EV, EVENT_FILL, FULL_LEGS, FULL_TWA, LEDGER_TWA, PLAIN_LEGS, PLAIN_TWA, RF, SIDES, TARGETS,
    TR, TWA_COLUMNS, Ctx, _day, day, query, twa_views, with_,
)
from tideledger.catalog.events import HOLDERS_SQL, MOVES, STUDIED, _BASE41, holders, studied
from tideledger.operators import attribution as at, legs as lg, monthly as mo, reports as rp, state as st
from tideledger.operators.twa import (
    FILL_DAY, balance_intervals, daily_snapshots, daily_twa, expand_days, positive,
    single_code_daily, to_daily, windowed_daily,
)
from tideledger.session import shared_dir
from tideledger.sources import store
from tideledger.sources.driver_tables import EXCLUDED

FILL = _day(EVENT_FILL)


def _twa(df):
    """Balance-seconds as double, like the hashes of the SQL twin."""
    return df.withColumn("segment_balance_time_product", F.col("segment_balance_time_product").cast("double"))


@query("d10_daily_twa", with_(FULL_TWA) + f"SELECT {TWA_COLUMNS} FROM daily WHERE user_addr NOT IN ('u3', 'u7')")
def d10(c: Ctx):
    return _twa(to_daily(balance_intervals(lg.drop_holders(c.legs, EXCLUDED), FILL)))


@query("d10_daily_twa_real_codes", with_(PLAIN_TWA) + f"SELECT {TWA_COLUMNS} FROM daily")
def d10_real(c: Ctx):
    return _twa(daily_twa(c.plain_legs, FILL))


@query("d10_daily_twa_stakes", with_(EV, RF, "st AS (SELECT 'main' AS blockchain, token AS contract_address, tx_hash, block_number, first_index AS log_index, "
       "block_time, u AS user_addr, cents AS amount, CASE WHEN event_type = 'signup' THEN 1 ELSE -1 END AS sign FROM ev WHERE event_type IN ('signup', 'error'))",
       TARGETS, """legs AS (SELECT s.blockchain, s.contract_address, t.symbol, s.user_addr, s.block_number AS block, s.log_index, 0 AS leg_seq,
  s.block_time AS ts, s.sign * s.amount AS amount_change, r.ref_code FROM st s JOIN targets t USING (blockchain, contract_address)
  LEFT JOIN rf r ON r.tx_hash = s.tx_hash AND r.owner = s.user_addr)""", twa_views(EVENT_FILL)) + f"SELECT {TWA_COLUMNS} FROM daily")
def d10_stakes(c: Ctx):
    return _twa(daily_twa(lg.stake_legs(c.st, at.real_codes(c.rf), c.targets), FILL))


@query("d10_ledger_wallet_days", with_(LEDGER_TWA) + """
SELECT blockchain, symbol, user_addr, count(*) AS days, CAST(sum(prod // 1000) AS BIGINT) AS kilo_seconds, min(dt) AS first_dt, max(dt) AS last_dt
FROM daily GROUP BY ALL""")
def d10_ledger(c: Ctx):
    iv = positive(c.ledger_intervals)
    seconds = F.when(F.col("day_type") == FILL_DAY, F.col("balance") * 86400).otherwise(F.col("prod"))
    n = F.datediff("end_dt", "start_dt") + 1
    return iv.groupBy("blockchain", "symbol", "user_addr").agg(
        F.sum(n).cast("bigint").alias("days"), F.sum(F.floor(seconds / 1000).cast("bigint") * n).alias("kilo_seconds"),
        F.min("start_dt").alias("first_dt"), F.max("end_dt").alias("last_dt"))


@query("p5_positive_only", with_(PLAIN_TWA) + "SELECT day_type, count(*) AS rows FROM daily GROUP BY 1")
def p5(c: Ctx):
    return daily_twa(c.plain_legs, FILL).groupBy("day_type").agg(F.count("*").alias("rows"))


@query("a7_segment_sums", with_(PLAIN_TWA) + """
SELECT contract_address, user_addr, dt, ref_code, dur, CAST(prod AS DOUBLE) AS prod FROM seg WHERE dur > 0""")
def a7(c: Ctx):
    iv = balance_intervals(c.plain_legs, FILL).filter(F.col("day_type") != FILL_DAY)
    return iv.select("contract_address", "user_addr", F.col("start_dt").alias("dt"), "ref_code", "dur", F.col("prod").cast("double").alias("prod"))


@query("j12_calendar_join", with_(PLAIN_TWA) + """
SELECT contract_address, user_addr, dt, ref_code, day_type, ends_day FROM daily_all WHERE seg_dur IS NULL OR seg_dur > 0""")
def j12(c: Ctx):
    return expand_days(balance_intervals(c.plain_legs, FILL)).select("contract_address", "user_addr", "dt", "ref_code", "day_type", "ends_day")


@query("d11_fill_always", with_(PLAIN_LEGS, twa_views(EVENT_FILL, always=True)) + f"SELECT {TWA_COLUMNS} FROM daily")
def d11(c: Ctx):
    return _twa(daily_twa(c.plain_legs, FILL, fill="always"))


@query("d12_daily_snapshots", with_(EV, TR, HOLDERS_SQL) + f"""
, days AS (SELECT user_addr, {day('ts')} AS dt, CAST(sum(amount_change) AS BIGINT) AS net FROM holder_legs GROUP BY ALL),
cal AS (SELECT DISTINCT user_addr, CAST(unnest(generate_series(TIMESTAMP '2023-12-25', TIMESTAMP '2024-02-05', INTERVAL 1 DAY)) AS DATE) AS dt FROM days)
SELECT user_addr, dt, CAST(coalesce(sum(net) OVER (PARTITION BY user_addr ORDER BY dt ROWS UNBOUNDED PRECEDING), 0) AS DOUBLE) AS balance
FROM cal LEFT JOIN days USING (user_addr, dt)""")
def d12(c: Ctx):
    legs = lg.holder_legs(c.tr, holders(c))
    return daily_snapshots(legs, date(2023, 12, 25), FILL, ["user_addr"])


@query("d12_holder_twa", with_(EV, TR, HOLDERS_SQL, twa_views(EVENT_FILL, legs="holder_legs")) + f"SELECT {TWA_COLUMNS} FROM daily")
def d12_twa(c: Ctx):
    return _twa(daily_twa(lg.holder_legs(c.tr, holders(c)), FILL))


@query("d13_window_with_opening", with_(FULL_LEGS, twa_views("2024-01-20")) + """
SELECT contract_address, user_addr, dt, ref_code, twab AS time_weighted_avg_balance
FROM daily WHERE dt BETWEEN DATE '2024-01-11' AND DATE '2024-01-20'
  AND NOT (dt > (SELECT max(dt) FROM day_end d WHERE d.user_addr = daily.user_addr AND d.contract_address = daily.contract_address AND d.dt <= DATE '2024-01-20')
           AND (SELECT arg_max(end_bal, dt) FROM day_end d WHERE d.user_addr = daily.user_addr AND d.contract_address = daily.contract_address AND d.dt <= DATE '2024-01-20') <= 1e-9)""")
def d13(c: Ctx):
    return windowed_daily(c.legs, date(2024, 1, 11), date(2024, 1, 21)).select(
        "contract_address", "user_addr", "dt", "ref_code", "time_weighted_avg_balance")


@query("d13_windows_union", with_(FULL_LEGS, twa_views("2024-01-31")) + """
SELECT contract_address, user_addr, dt, ref_code, twab AS time_weighted_avg_balance FROM daily WHERE dt <= DATE '2024-01-31'""")
def d13_union(c: Ctx):
    cuts = [date(2024, 1, 1), date(2024, 1, 9), date(2024, 1, 17), date(2024, 1, 25), date(2024, 2, 1)]
    out = None
    for a, b in zip(cuts, cuts[1:]):
        part = windowed_daily(c.legs, a, b).select("contract_address", "user_addr", "dt", "ref_code", "time_weighted_avg_balance")
        out = part if out is None else out.unionByName(part)
    return out


_CUTS = [date(2024, 1, 1), date(2024, 1, 9), date(2024, 1, 17), date(2024, 1, 25), date(2024, 2, 1)]
_WINDOWS_SQL = with_(FULL_LEGS, twa_views("2024-01-31")) + """
SELECT contract_address, user_addr, dt, ref_code, twab AS time_weighted_avg_balance FROM daily WHERE dt <= DATE '2024-01-31'"""


def _chained(legs, root: str, cuts=_CUTS):
    """Windows in sequence, each from the stored state of the one before; the results are stored as they come."""
    parts = {}
    for a, b in zip(cuts, cuts[1:]):
        daily = st.advance(legs, f"{root}/state", a, b, genesis=a == _CUTS[0])
        parts[a, b] = store.stage(daily, f"{root}/daily-{a}-{uuid.uuid4().hex}")
    return parts


def _days(parts):
    return reduce(lambda x, y: x.unionByName(y), parts.values()).select("contract_address", "user_addr", "dt", "ref_code", "time_weighted_avg_balance")


@query("d13_chained_state", _WINDOWS_SQL)
def d13_chained(c: Ctx):
    root = f"{shared_dir(c.spark)}/tideledger/chain-{uuid.uuid4().hex}"
    return _days(_chained(store.stage(c.legs, f"{root}/legs"), root))


@query("d13_late_logs", _WINDOWS_SQL)
def d13_late(c: Ctx):
    # One block in nine of the first two weeks arrives after three windows are settled: the states are merged, the windows they touch issued again.
    root = f"{shared_dir(c.spark)}/tideledger/late-{uuid.uuid4().hex}"
    legs = store.stage(c.legs, f"{root}/legs")
    late = (F.col("block") % 9 == 4) & (F.col("ts") >= 1704758400) & (F.col("ts") < 1705363200)  # 2024-01-09 to 2024-01-15
    parts = _chained(legs.filter(~late), root, _CUTS[:4])
    changed = st.apply_late(legs.filter(late), f"{root}/state")
    for a, b in list(parts):
        if a in changed or b in changed:
            parts[a, b] = st.advance(legs, f"{root}/state", a, b)
    parts[_CUTS[3], _CUTS[4]] = st.advance(legs, f"{root}/state", _CUTS[3], _CUTS[4])
    return _days(parts)


@query("d13_state_merge", with_(FULL_LEGS) + """
SELECT contract_address, symbol, user_addr, CAST(sum(amount_change) AS DOUBLE) AS balance, arg_max(ref_code, block * 100 + log_index * 2 + leg_seq) FILTER (WHERE ref_code IS NOT NULL) AS code,
  max(block) AS last_block FROM legs WHERE ts < 1706140800 GROUP BY ALL""")
def d13_merge(c: Ctx):
    # States of slices of the legs, merged pairwise in an order of their own.
    legs = st.of_window(c.legs, date(2023, 12, 1), date(2024, 1, 25))
    slices = [st.partial_state(legs.filter(F.col("block") % 3 == i)) for i in range(3)]
    merged = st.merge_states(slices[2], st.merge_states(slices[0], slices[1]))
    return merged.select("contract_address", "symbol", "user_addr", F.col("net").cast("double").alias("balance"), "code",
                         F.floor(F.col("last_at") / F.lit(Decimal(10**19))).cast("bigint").alias("last_block"))


@query("d16_idle_series", with_(EV, TR, HOLDERS_SQL, "codeless AS (SELECT * REPLACE (NULL::BIGINT AS ref_code) FROM holder_legs)",
       twa_views(EVENT_FILL, legs="codeless", always=True)) + "SELECT contract_address, user_addr, dt, CAST(sum(prod) AS DOUBLE) / 86400.0 AS idle FROM daily_all GROUP BY ALL")
def d16(c: Ctx):
    return mo.idle_series(lg.holder_legs(c.tr, holders(c)), FILL, ["contract_address", "user_addr"])


@query("d16_idle_series_covered_seconds", with_(EV, TR, HOLDERS_SQL, "codeless AS (SELECT * REPLACE (NULL::BIGINT AS ref_code) FROM holder_legs)",
       twa_views(EVENT_FILL, legs="codeless", always=True)) + """
SELECT contract_address, user_addr, dt, CAST(sum(prod) AS DOUBLE) / CAST(coalesce(sum(seg_dur), 86400) AS DOUBLE) AS idle FROM daily_all GROUP BY ALL""")
def d16_covered(c: Ctx):
    return mo.idle_series(lg.holder_legs(c.tr, holders(c)), FILL, ["contract_address", "user_addr"], covered_seconds=True)


_K3 = "blockchain, contract_address, user_addr"
SINGLE = with_(*_BASE41, STUDIED, twa_views(EVENT_FILL, legs="studied", keys=_K3))


@query("d40_single_code_days", SINGLE + "SELECT contract_address, user_addr, dt, twab AS twa_balance FROM daily WHERE ref_code = 1004 AND ends_day")
def d40(c: Ctx):
    iv = balance_intervals(studied(c), FILL, ["blockchain", "contract_address", "user_addr"])
    return single_code_daily(iv, 1004).drop("blockchain")


STICKY = """credited AS (SELECT contract_address, tx_hash, user_addr FROM (SELECT token AS contract_address, tx_hash, u AS user_addr FROM ev WHERE event_type = 'purchase')),
nonzero AS (SELECT contract_address, tx_hash, owner AS user_addr, arg_max(ref_code, log_index) AS code FROM rf WHERE ref_code <> 0 GROUP BY ALL),
sticky AS (SELECT m.blockchain, m.contract_address, m.user_addr, m.block_number AS block, m.log_index, m.leg_seq, m.block_time AS ts, m.delta AS amount_change,
    CASE WHEN c.tx_hash IS NOT NULL THEN 1003 ELSE n.code END AS ref_code
  FROM moves m LEFT JOIN credited c USING (contract_address, tx_hash, user_addr) LEFT JOIN nonzero n USING (contract_address, tx_hash, user_addr)
  WHERE (m.contract_address, m.user_addr) IN (SELECT contract_address, user_addr FROM credited))"""
PROGRAM_DAYS = with_(EV, TR, RF, SIDES, MOVES, STICKY, twa_views(EVENT_FILL, legs="sticky", keys=_K3))


def sticky_days(c: Ctx):
    credited = c.ev.filter("event_type = 'purchase'").select(
        F.lit("main").alias("blockchain"), F.col("token").alias("contract_address"), "tx_hash", F.col("u").alias("user_addr"))
    legs = at.sticky_program_legs(credited, c.tr, c.rf, 1003)
    iv = balance_intervals(legs, FILL, ["blockchain", "contract_address", "user_addr"])
    return single_code_daily(iv, 1003)


@query("d39_sticky_program_days", PROGRAM_DAYS + "SELECT contract_address, user_addr, dt, twab AS twa_balance FROM daily WHERE ref_code = 1003 AND ends_day")
def d39_days(c: Ctx):
    return sticky_days(c).drop("blockchain")


@query("d39_sticky_program_months", PROGRAM_DAYS + """
, priced AS (SELECT CAST(date_trunc('month', dt) AS DATE) AS month, contract_address AS blockchain, user_addr, twab * 1.5::DOUBLE AS twa_usds,
    twab / 365.0::DOUBLE * 0.005::DOUBLE * 1.5::DOUBLE AS dr_usd FROM daily WHERE ref_code = 1003 AND ends_day)
SELECT month, coalesce(blockchain, 'ALL') AS blockchain, count(DISTINCT user_addr) AS active_wallets, round(sum(twa_usds) / count(*), 1) AS avg_daily_twa_usds,
  round(sum(twa_usds), 1) AS sum_twa_usds, round(sum(dr_usd), 1) AS dr_usd
FROM priced GROUP BY GROUPING SETS ((month, blockchain), (month))""")
def d39(c: Ctx):
    daily = sticky_days(c).select(
        F.col("contract_address").alias("blockchain"), "user_addr", "dt", (F.col("twa_balance") * 1.5).alias("twa_usds"),
        (F.col("twa_balance") / 365.0 * F.lit(0.005) * 1.5).alias("dr_usd"))
    return rp.program_month_totals(daily, 1)
