"""Registry of checked queries and the SQL views their oracles share."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tideledger.functions import codec
from tideledger.operators import attribution as at, legs as lg
from tideledger.operators.twa import balance_intervals
from tideledger.session import prepare
from tideledger.sources import driver_tables as dt
from tideledger.sources.registry import REROUTED_CODES, programs_frame

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

EVENT_FILL = "2024-02-05"
LEDGER_FILL = "2030-08-31"
ZERO = codec.ZERO_ADDRESS


class Ctx:
    """The given tables as the engine's event tables, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = prepare(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        return dt.table(self.spark, self.sf, name)

    @cached_property
    def ev(self) -> DataFrame:
        return dt.base_events(self.spark, self.sf)

    @cached_property
    def tr(self) -> DataFrame:
        return dt.transfers(self.ev)

    @cached_property
    def rf(self) -> DataFrame:
        return dt.referrals(self.ev)

    @cached_property
    def sw(self) -> DataFrame:
        return dt.swaps(self.ev)

    @cached_property
    def st(self) -> DataFrame:
        return dt.stakes(self.ev)

    @cached_property
    def vf(self) -> DataFrame:
        return dt.vault_flows(self.ev)

    @cached_property
    def logs(self) -> DataFrame:
        return dt.hex_logs(self.ev)

    @cached_property
    def targets(self) -> DataFrame:
        return dt.token_targets(self.spark)

    @cached_property
    def programs(self) -> DataFrame:
        return programs_frame(self.spark, dt.PROGRAMS)

    @cached_property
    def code_maps(self) -> list[DataFrame]:
        return [at.real_codes(self.rf), at.rerouted_codes(self.rf, self.tr, REROUTED_CODES),
                at.delivery_codes(self.tr, self.programs)]

    @cached_property
    def legs(self) -> DataFrame:
        """Legs with every kind of code."""
        return lg.transaction_legs(self.tr, self.code_maps[:2], self.targets, programs=self.programs)

    @cached_property
    def plain_legs(self) -> DataFrame:
        """Legs with real codes only."""
        return lg.transfer_legs(self.tr, at.real_codes(self.rf), self.targets)

    @cached_property
    def intervals(self) -> DataFrame:
        return balance_intervals(self.legs, _day(EVENT_FILL))

    @cached_property
    def ledger(self) -> DataFrame:
        return dt.ledger_legs(self.spark, self.sf)

    @cached_property
    def ledger_intervals(self) -> DataFrame:
        return balance_intervals(self.ledger, _day(LEDGER_FILL))


def _day(text: str):
    from datetime import date

    return date.fromisoformat(text)


def query(name: str, sql: str | None = None):
    """Register ``fn(ctx) -> DataFrame`` and, when given, its SQL twin."""

    def register(fn: Callable[[Ctx], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Ctx(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# --- SQL views ----------------------------------------------------------------

EV = """ev AS (
  SELECT event_id, event_type, event_id // 4 AS block_number, (event_id % 4) * 4 AS first_index,
    'tx' || event_id AS tx_hash, 'tok' || (user_id % 2) AS token, 'u' || user_id AS u,
    'u' || (user_id + event_id % 5) AS cp, CAST(round(value * 100) AS BIGINT) AS cents,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    min(CAST(floor(epoch(ts)) AS BIGINT)) OVER (PARTITION BY event_id // 4) AS block_time
  FROM events)"""

_T = "'main' AS blockchain, token AS contract_address, tx_hash, block_number, first_index + {i} AS log_index, block_time"


def _t(i: int, frm: str, to: str, amount: str, kind: str) -> str:
    return (f"SELECT {_T.format(i=i)}, {frm} AS from_addr, {to} AS to_addr, {amount} AS amount "
            f"FROM ev WHERE event_type = '{kind}'")


TR = "tr AS (" + " UNION ALL ".join([
    _t(0, f"'{ZERO}'", "u", "cents", "signup"),
    _t(0, f"'{ZERO}'", "'prog'", "cents", "purchase"), _t(1, "'prog'", "u", "cents", "purchase"),
    _t(0, f"'{ZERO}'", "'router'", "cents", "view"), _t(2, "'router'", "u", "cents", "view"),
    _t(0, "u", f"'{ZERO}'", "cents // 2", "error"),
    _t(0, "u", "cp", "cents // 4", "click"),
]) + ")"

RF = f"""rf AS (
  SELECT {_T.format(i=1)}, u AS owner, k AS ref_code FROM ev WHERE event_type = 'signup'
  UNION ALL
  SELECT {_T.format(i=1)}, 'router' AS owner, CAST(CASE WHEN k % 2 = 0 THEN 1004 ELSE 4011 END AS BIGINT)
  FROM ev WHERE event_type = 'view')"""

SW = f"""sw AS (
  SELECT {_T.format(i=3)}, 'other_in' AS asset_in, CASE WHEN k % 2 = 0 THEN token ELSE 'other' END AS asset_out,
    u AS receiver, cents AS amount_out, CASE WHEN k % 10 = 9 THEN k + 1000000000 ELSE k END AS ref_code
  FROM ev WHERE event_type = 'signup')"""

ST = f"""st AS (
  SELECT {_T.format(i=0)}, u AS user_addr, cents AS amount, CASE WHEN event_type = 'signup' THEN 1 ELSE -1 END AS sign
  FROM ev WHERE event_type IN ('signup', 'error'))"""

VF = f"""vf AS (
  SELECT {_T.format(i=0)}, u AS owner, cents * (k + 100) AS assets, cents * 100 AS shares
  FROM ev WHERE event_type = 'purchase')"""

TARGETS = """targets AS (SELECT * FROM (VALUES ('main', 'tok0', 'sUSDS'), ('main', 'tok1', 'sUSDC'))
  AS t(blockchain, contract_address, symbol))"""

SIDES = f"""sides AS (
  SELECT blockchain, contract_address, tx_hash, block_number, log_index, block_time, from_addr, to_addr,
    to_addr AS user_addr, amount AS delta, 0 AS leg_seq FROM tr WHERE to_addr <> '{ZERO}'
  UNION ALL
  SELECT blockchain, contract_address, tx_hash, block_number, log_index, block_time, from_addr, to_addr,
    from_addr, -amount, 1 FROM tr WHERE from_addr <> '{ZERO}')"""

NET = """net AS (SELECT blockchain, contract_address, tx_hash, user_addr, CAST(sum(delta) AS BIGINT) AS net
  FROM sides GROUP BY ALL)"""

REAL = """real_codes AS (
  SELECT blockchain, contract_address, tx_hash, owner AS user_addr, log_index, ref_code, 'real' AS kind FROM (
    SELECT *, row_number() OVER (PARTITION BY contract_address, tx_hash, owner ORDER BY log_index DESC) AS rn FROM rf)
  WHERE rn = 1)"""

DELIVERY = f"""delivery AS (
  SELECT blockchain, contract_address, tx_hash, user_addr, log_index, ref_code, 'delivery' AS kind FROM (
    SELECT t.blockchain, t.contract_address, t.tx_hash, t.to_addr AS user_addr, t.log_index, CAST(1003 AS BIGINT) AS ref_code,
      row_number() OVER (PARTITION BY t.contract_address, t.tx_hash, t.to_addr ORDER BY t.log_index DESC) AS rn
    FROM tr t JOIN net n ON n.tx_hash = t.tx_hash AND n.contract_address = t.contract_address AND n.user_addr = t.to_addr
    WHERE t.from_addr = 'prog' AND t.to_addr NOT IN ('prog', '{ZERO}') AND n.net > 0) WHERE rn = 1)"""

REROUTED = f"""owner_counts AS (
  SELECT contract_address, owner, count(*) AS n FROM rf WHERE ref_code IN (1004, 4011) GROUP BY ALL),
owned AS (
  SELECT contract_address, tx_hash, owner, arg_max(ref_code, log_index) AS code FROM rf
  WHERE ref_code IN (1004, 4011) AND (contract_address, owner) IN (SELECT (contract_address, owner) FROM owner_counts WHERE n >= 3)
  GROUP BY ALL),
rerouted AS (
  SELECT blockchain, contract_address, tx_hash, user_addr, log_index, ref_code, 'rerouted' AS kind FROM (
    SELECT t.blockchain, t.contract_address, t.tx_hash, t.to_addr AS user_addr, t.log_index, o.code AS ref_code,
      row_number() OVER (PARTITION BY t.contract_address, t.tx_hash, t.to_addr ORDER BY t.log_index DESC) AS rn
    FROM tr t
    JOIN owned o ON o.tx_hash = t.tx_hash AND o.contract_address = t.contract_address AND o.owner = t.from_addr
    JOIN net no ON no.tx_hash = t.tx_hash AND no.contract_address = t.contract_address AND no.user_addr = t.from_addr
    JOIN net nw ON nw.tx_hash = t.tx_hash AND nw.contract_address = t.contract_address AND nw.user_addr = t.to_addr
    WHERE t.to_addr <> '{ZERO}' AND no.net <= 0 AND nw.net > 0
      AND NOT EXISTS (SELECT 1 FROM owned x WHERE x.tx_hash = t.tx_hash AND x.contract_address = t.contract_address AND x.owner = t.to_addr)
  ) WHERE rn = 1)"""

MERGED = """merged AS (
  SELECT blockchain, contract_address, tx_hash, user_addr, log_index, ref_code, kind FROM (
    SELECT *, row_number() OVER (PARTITION BY contract_address, tx_hash, user_addr ORDER BY
      CASE kind WHEN 'real' THEN 3 WHEN 'rerouted' THEN 2 ELSE 1 END DESC, log_index DESC) AS rn
    FROM (SELECT * FROM real_codes UNION ALL SELECT * FROM rerouted UNION ALL SELECT * FROM delivery)) WHERE rn = 1)"""


def legs_view(name: str, codes: str) -> str:
    return f"""{name} AS (
  SELECT s.blockchain, s.contract_address, t.symbol, s.user_addr, s.block_number AS block, s.log_index, s.leg_seq,
    s.block_time AS ts, s.delta AS amount_change, c.ref_code
  FROM sides s JOIN targets t USING (blockchain, contract_address)
  LEFT JOIN {codes} c ON c.tx_hash = s.tx_hash AND c.contract_address = s.contract_address AND c.user_addr = s.user_addr)"""


ATTRIBUTION = ",\n".join([EV, TR, RF, TARGETS, SIDES, NET, REAL, DELIVERY, REROUTED, MERGED])
FULL_LEGS = ATTRIBUTION + ",\n" + legs_view("legs", "merged")
PLAIN_LEGS = ",\n".join([EV, TR, RF, TARGETS, SIDES, REAL, legs_view("legs", "real_codes")])

LEDGER = """legs AS (
  SELECT 'chain' || (c_nationkey % 3) AS blockchain, 'vault_' || tk AS contract_address, tk AS symbol,
    'c' || o_custkey AS user_addr, d AS block, o_orderkey AS log_index, 0 AS leg_seq,
    d * 86400 + o_orderkey % 86400 AS ts,
    CASE WHEN o_orderstatus = 'F' THEN -(cents // 2) ELSE cents END AS amount_change,
    CASE WHEN digit <= 3 THEN digit END AS ref_code
  FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
          CAST(epoch(date_trunc('day', o_orderdate)) / 86400 AS BIGINT) + 10592 AS d,
          CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS digit,
          ['sUSDS','sUSDC','stUSDS','USDS-SKY','spUSDC','spUSDT','spPYUSD','spETH'][o_custkey % 8 + 1] AS tk
        FROM orders JOIN customer ON c_custkey = o_custkey))"""

DAY = "CAST(DATE '1970-01-01' + CAST({ts} // 86400 AS INTEGER) AS DATE)"


def day(ts: str) -> str:
    return DAY.format(ts=ts)


def twa_views(fill_through: str, legs: str = "legs", p: str = "", keys: str = "blockchain, contract_address, symbol, user_addr",
              always: bool = False, first_midnight: str | None = None) -> str:
    """Daily balances the plain way: running windows, midnight rows, calendar, forward fill.

    Ends in ``{p}daily`` with prod (balance-seconds of the day), twab and ends_day.
    """
    skip = f" AND dt > DATE '{first_midnight}'" if first_midnight else ""
    using = f"USING ({keys}, dt)"
    return f"""{p}running AS (
  SELECT {keys}, block, log_index, leg_seq, ts, {day('ts')} AS dt,
    CAST(sum(amount_change) OVER w AS BIGINT) AS bal,
    coalesce(last_value(ref_code IGNORE NULLS) OVER w, -999999) AS code
  FROM {legs}
  WINDOW w AS (PARTITION BY {keys} ORDER BY block, log_index, leg_seq ROWS UNBOUNDED PRECEDING)),
{p}day_end AS (
  SELECT {keys}, dt, bal AS end_bal, code AS end_code FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys}, dt ORDER BY block DESC, log_index DESC, leg_seq DESC) AS rn FROM {p}running)
  WHERE rn = 1),
{p}day_start AS (
  SELECT {keys}, dt, coalesce(lag(end_bal) OVER w, 0) AS bal, coalesce(lag(end_code) OVER w, -999999) AS code
  FROM {p}day_end WINDOW w AS (PARTITION BY {keys} ORDER BY dt)),
{p}states AS (
  SELECT {keys}, dt, block, log_index, leg_seq, ts, bal, code FROM {p}running
  UNION ALL
  SELECT {keys}, dt, 0, -1, 0, CAST(epoch(dt) AS BIGINT), bal, code FROM {p}day_start WHERE true{skip}),
{p}held AS (
  SELECT {keys}, dt, bal, code,
    coalesce(lead(ts) OVER (PARTITION BY {keys}, dt ORDER BY block, log_index, leg_seq), CAST(epoch(dt) AS BIGINT) + 86400) - ts AS dur
  FROM {p}states),
{p}seg AS (
  SELECT {keys}, dt, code AS ref_code, CAST(sum(dur) AS BIGINT) AS dur, CAST(sum(bal * dur) AS BIGINT) AS prod
  FROM {p}held GROUP BY ALL),
{p}span AS (
  SELECT {keys}, min(dt) AS d1, CASE WHEN {'true' if always else 'arg_max(end_bal, dt) > 1e-9'}
    THEN greatest(max(dt), DATE '{fill_through}') ELSE max(dt) END AS d2
  FROM {p}day_end GROUP BY ALL),
{p}cal AS (SELECT {keys}, CAST(unnest(generate_series(CAST(d1 AS TIMESTAMP), CAST(d2 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS dt FROM {p}span),
{p}daily_all AS (
  SELECT {', '.join('c.' + k.strip() for k in keys.split(','))}, c.dt, coalesce(s.ref_code, f.code) AS ref_code,
    CASE WHEN s.prod IS NOT NULL THEN s.prod ELSE f.bal * 86400 END AS prod,
    CASE WHEN s.prod IS NOT NULL THEN CAST(s.prod AS DOUBLE) / 86400.0 ELSE CAST(f.bal AS DOUBLE) END AS twab,
    CASE WHEN s.prod IS NOT NULL THEN 'transaction_day' ELSE 'no_transaction_day' END AS day_type,
    s.dur AS seg_dur, s.prod AS seg_prod, coalesce(s.ref_code, f.code) = f.code AS ends_day
  FROM {p}cal c
  LEFT JOIN {p}seg s {using}
  JOIN (SELECT {keys}, dt, last_value(end_bal IGNORE NULLS) OVER w AS bal, last_value(end_code IGNORE NULLS) OVER w AS code
        FROM {p}cal LEFT JOIN {p}day_end {using}
        WINDOW w AS (PARTITION BY {keys} ORDER BY dt ROWS UNBOUNDED PRECEDING)) f {using}),
{p}daily AS (SELECT * FROM {p}daily_all WHERE twab > 0)"""


TWA_COLUMNS = """blockchain, contract_address, symbol, user_addr, dt, ref_code, twab AS time_weighted_avg_balance, day_type,
  seg_dur AS segment_duration_seconds, CAST(seg_prod AS DOUBLE) AS segment_balance_time_product"""

FULL_TWA = FULL_LEGS + ",\n" + twa_views(EVENT_FILL)
PLAIN_TWA = PLAIN_LEGS + ",\n" + twa_views(EVENT_FILL)
LEDGER_TWA = LEDGER + ",\n" + twa_views(LEDGER_FILL)

RATES = """rates AS (
  SELECT reward_code, apy, start_dt, end_dt,
    CASE WHEN apy = 0 THEN 0.0 ELSE 365.0 * (exp(ln(1.0::DOUBLE + apy) / 365.0::DOUBLE) - 1.0) END AS reward_per
  FROM (SELECT reward_code, CAST(apy AS DOUBLE) AS apy, start_dt, end_dt FROM (VALUES
    ('XR', 0.006, DATE '2024-01-01', DATE '2025-12-31'), ('XR', 0.005, DATE '2026-01-01', DATE '2026-07-08'),
    ('XR', 0.002, DATE '2026-07-09', DATE '2030-12-31'), ('XR-stUSDS', 0.006, DATE '2024-01-01', DATE '2025-12-31'),
    ('XR-stUSDS', 0.001, DATE '2026-01-01', DATE '2030-12-31'), ('XR*', 0.006, DATE '2024-01-01', DATE '2025-12-31'),
    ('XR*', 0.002, DATE '2026-01-01', DATE '2030-12-31')) AS t(reward_code, apy, start_dt, end_dt)))"""

REWARD_CODE = """CASE WHEN {t} = 'stUSDS' THEN 'XR-stUSDS' WHEN {t} IN ('spUSDC', 'spUSDT', 'spPYUSD', 'spETH') THEN 'XR*' ELSE 'XR' END"""


def with_(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"


def months_between(first: str, last: str) -> list[str]:
    y, m = int(first[:4]), int(first[5:7])
    out = []
    while f"{y}-{m:02d}" <= last[:7]:
        out.append(f"{y}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


LEDGER_MONTHS = months_between("2024-01", "2030-08")
