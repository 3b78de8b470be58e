"""Rollups, report tables, comparisons and payments.

The monthly input is the ledger's positive flows priced at one cent per 100
units, so month sums are exact in both engines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tideledger.catalog.base import EV, FULL_TWA, LEDGER, LEDGER_MONTHS, RATES, REWARD_CODE, TR, Ctx, day, query, with_
from tideledger.catalog.scalars import GROUP_SQL
from tideledger.catalog.studies import FILL, full
from tideledger.functions.dates import day_of
from tideledger.functions.labels import NON_PAYABLE_CODES
from tideledger.operators import rates as rt, reconcile as rc, rollup as ru
from tideledger.operators.twa import daily_twa

CODES = "coalesce(ref_code, CASE WHEN symbol = 'sUSDS' THEN 99 WHEN symbol = 'sUSDC' THEN 127 WHEN symbol = 'stUSDS' THEN 1003 ELSE 0 END)"
MONTHLY = LEDGER + f""",
monthly AS (SELECT CAST(date_trunc('month', {day('ts')}) AS DATE) AS month, strftime({day('ts')}, '%Y-%m') AS m, blockchain, symbol AS token, {CODES} AS ref_code,
  CASE WHEN symbol LIKE 'sp%' THEN 'sp' ELSE 'other' END AS source, CAST(sum(abs(amount_change)) AS DOUBLE) / 128.0 AS dr_usd FROM legs GROUP BY ALL)"""


def monthly(c: Ctx):
    s = F.col("symbol")
    code = F.coalesce("ref_code", F.when(s == "sUSDS", 99).when(s == "sUSDC", 127).when(s == "stUSDS", 1003).otherwise(0).cast("bigint"))
    return c.ledger.groupBy(
        F.trunc(day_of(F.col("ts")), "MM").alias("month"), "blockchain", s.alias("token"), code.alias("ref_code"),
        F.when(s.startswith("sp"), F.lit("sp")).otherwise(F.lit("other")).alias("source"),
    ).agg((F.sum(F.abs("amount_change")).cast("double") / F.lit(128.0)).alias("dr_usd"))


def pivot_sql(keys: str, key_exprs: str, zero: bool = False, total: str = "total_dr_usd", src: str = "monthly") -> str:
    cell = "coalesce(sum(CASE WHEN m = '{m}' THEN dr_usd END), 0.0)" if zero else "sum(CASE WHEN m = '{m}' THEN dr_usd END)"
    cells = ", ".join(f"{cell.format(m=m)} AS \"{m}\"" for m in LEDGER_MONTHS)
    return f"SELECT {key_exprs}, {cells}, sum(dr_usd) AS {total} FROM {src} GROUP BY {keys}"


@query("a11_pivot_months", with_(MONTHLY) + pivot_sql("ref_code", "ref_code", zero=True, total="total"))
def a11(c: Ctx):
    return ru.wide_by_month(monthly(c), ["ref_code"], LEDGER_MONTHS, blank="zero", total="total")


_LABEL = "CASE WHEN ref_code IN (0, 1) THEN ref_code || ' (' || token || ')' ELSE CAST(ref_code AS VARCHAR) END"


@query("d23_rollup_by_code", with_(MONTHLY) + pivot_sql("1", f"{_LABEL} AS ref_code"))
def d23_code(c: Ctx):
    return ru.rollup_by_code(monthly(c), LEDGER_MONTHS)


@query("d23_rollup_by_code_token", with_(MONTHLY) + pivot_sql("ref_code, token", "ref_code, token"))
def d23_token(c: Ctx):
    return ru.rollup_by_code_token(monthly(c), LEDGER_MONTHS)


@query("d23_rollup_detail", with_(MONTHLY) + pivot_sql("ref_code, token, blockchain, source", "ref_code, token, blockchain, source"))
def d23_detail(c: Ctx):
    return ru.rollup_detail(monthly(c), LEDGER_MONTHS)


@query("p9_settle_month", with_(MONTHLY) + "SELECT month, sum(dr_usd) AS dr_usd FROM monthly WHERE m <= '2026-06' GROUP BY 1")
def p9(c: Ctx):
    kept = monthly(c).filter(ru.month_label(F.col("month")) <= "2026-06")
    return kept.groupBy("month").agg(F.sum("dr_usd").alias("dr_usd"))


_MONTHS_SEEN = "SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders"
_SLICED = f"""slices AS (SELECT 'c' || (month(m) % 3) AS source, m AS slice_start, CAST(m + to_days(CASE WHEN month(m) % 5 = 0 THEN 10 ELSE 35 END) AS DATE) AS slice_end FROM ({_MONTHS_SEEN})),
reached AS (SELECT *, max(slice_end) OVER (PARTITION BY source ORDER BY slice_start, slice_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM slices)"""


def slices(c: Ctx):
    """A slice for every month with orders, in three series; most reach into the next month, some end early."""
    m = F.trunc(F.to_date("o_orderdate"), "MM")
    months = c.table("orders").select(m.alias("slice_start")).distinct()
    return months.select(F.concat(F.lit("c"), F.month("slice_start") % 3).alias("source"), "slice_start",
                         F.date_add("slice_start", F.when(F.month("slice_start") % 5 == 0, F.lit(10)).otherwise(F.lit(35))).alias("slice_end"))


@query("d24_window_coverage", "WITH " + _SLICED.replace("'c' || (month(m) % 3)", "'all'") + """
SELECT 'gap' AS problem, greatest(coalesce(reach, DATE '1995-01-01'), DATE '1995-01-01') AS from_dt, slice_start AS to_dt FROM reached WHERE slice_start > greatest(coalesce(reach, DATE '1995-01-01'), DATE '1995-01-01')
UNION ALL SELECT 'short', max(slice_end), DATE '2002-01-01' FROM slices""")
def d24(c: Ctx):
    return rc.assert_coverage(slices(c), "1995-01-01", "2002-01-01")


@query("d24_coverage_by_source", "WITH " + _SLICED + """
SELECT source, 'gap' AS problem, greatest(coalesce(reach, DATE '1995-01-01'), DATE '1995-01-01') AS from_dt, least(slice_start, DATE '2001-09-01') AS to_dt FROM reached
  WHERE slice_start > greatest(coalesce(reach, DATE '1995-01-01'), DATE '1995-01-01') AND greatest(coalesce(reach, DATE '1995-01-01'), DATE '1995-01-01') < DATE '2001-09-01'
UNION ALL SELECT source, 'short', max(slice_end), DATE '2001-09-01' FROM slices GROUP BY 1 HAVING max(slice_end) < DATE '2001-09-01'
UNION ALL SELECT source, 'overlap', slice_start, least(slice_end, reach) FROM reached WHERE slice_start < reach""")
def d24_sources(c: Ctx):
    return rc.coverage_problems(slices(c), "1995-01-01", "2002-01-01", ["source"], overlaps=True, tolerate_after="2001-09-01")


_NP = ", ".join(str(x) for x in NON_PAYABLE_CODES)
ELIG = "elig AS (SELECT * FROM (VALUES (1, '2025-03', NULL), (2, '2024-06', '2027-01'), (3, '2026-01', '2026-07')) AS t(ref_code, f, u))"
_YEAR = [m for m in LEDGER_MONTHS if m.startswith("2026")]


def eligibility(c: Ctx):
    return c.spark.sql("""select * from values (1L,'2025-03',cast(null as string)), (2L,'2024-06','2027-01'), (3L,'2026-01','2026-07')
        as t(ref_code, eligible_from, eligible_until)""")


@query("p11_payability_window", with_(MONTHLY, ELIG) + """
SELECT ref_code, m AS month, sum(dr_usd) AS dr_usd FROM monthly LEFT JOIN elig USING (ref_code)
WHERE m >= coalesce(f, '2026-01') AND (u IS NULL OR m < u) GROUP BY ALL""")
def p11(c: Ctx):
    rows = monthly(c).withColumn("month", ru.month_label(F.col("month"))).join(eligibility(c), "ref_code", "left")
    inside = (F.col("month") >= F.coalesce("eligible_from", F.lit("2026-01"))) & (F.col("eligible_until").isNull() | (F.col("month") < F.col("eligible_until")))
    return rows.filter(inside).groupBy("ref_code", "month").agg(F.sum("dr_usd").alias("dr_usd"))


_PAY_CELLS = ", ".join(f"round(sum(CASE WHEN m = '{m}' AND (inside OR NOT payable) THEN dr_usd END), 2) AS \"{m}\"" for m in _YEAR)


@query("d25_payable_view", with_(MONTHLY, ELIG, f"""x AS (SELECT m1.*, ref_code NOT IN ({_NP}) AS payable, coalesce(f, '2026-01') AS a, u,
  m >= coalesce(f, '2026-01') AND (u IS NULL OR m < u) AS inside FROM monthly m1 LEFT JOIN elig USING (ref_code))""") + f"""
SELECT ref_code, bool_or(payable) AS payable, max(CASE WHEN payable THEN a END) AS eligible_from, max(CASE WHEN payable THEN u END) AS eligible_until, {_PAY_CELLS},
  round(sum(CASE WHEN payable AND inside THEN dr_usd ELSE 0 END), 2) AS payable_total,
  round(sum(CASE WHEN NOT payable OR m < a THEN dr_usd ELSE 0 END), 2) AS excluded_total FROM x GROUP BY 1""")
def d25(c: Ctx):
    return ru.payable_view(monthly(c), eligibility(c), "2026-01", _YEAR)


_CELLS26 = ", ".join(f"round(sum(CASE WHEN m = '{m}' THEN dr_usd END), 2) AS \"{m}\"" for m in _YEAR)
_TOTAL26 = " + ".join(f"coalesce(\"{m}\", 0.0)" for m in _YEAR)


@query("d26_code_table", with_(MONTHLY, "y AS (SELECT * FROM monthly WHERE m LIKE '2026-%')", f"w AS (SELECT ref_code, {_CELLS26} FROM y GROUP BY 1)",
       "known AS (SELECT DISTINCT ref_code FROM monthly UNION SELECT CAST(n_nationkey AS BIGINT) FROM nation)") + f"""
SELECT k.ref_code, {', '.join(f'w."{m}"' for m in _YEAR)}, round(coalesce({_TOTAL26}, 0.0), 2) AS total, coalesce(t.tokens, '') AS tokens, coalesce(n_name, '') AS notes
FROM known k LEFT JOIN w USING (ref_code) LEFT JOIN (SELECT ref_code, string_agg(DISTINCT token, ', ' ORDER BY token) AS tokens FROM y WHERE dr_usd <> 0 GROUP BY 1) t USING (ref_code)
LEFT JOIN nation ON n_nationkey = k.ref_code""")
def d26(c: Ctx):
    m = monthly(c)
    nations = c.table("nation").select(F.col("n_nationkey").cast("bigint").alias("ref_code"), F.col("n_name").alias("note"))
    known = m.select("ref_code").union(nations.select("ref_code"))
    return ru.code_table(m.filter(ru.month_label(F.col("month")).startswith("2026-")), known, nations, _YEAR)


def _series(df, chain: str):
    return df.filter(F.col("blockchain") == chain).groupBy(
        F.col("ref_code").cast("string").alias("code"), ru.month_label(F.col("month")).alias("month")).agg(F.sum("dr_usd").alias("value"))


def series_sql(name: str, chain: str, merge: bool = False) -> str:
    code = "CASE WHEN ref_code IN (99, 127) THEN 'untagged' ELSE CAST(ref_code AS VARCHAR) END" if merge else "CAST(ref_code AS VARCHAR)"
    return f"{name} AS (SELECT {code} AS code, m AS month, sum(dr_usd) AS value FROM monthly WHERE blockchain = '{chain}' GROUP BY 1, 2)"


DIFF = """d AS (SELECT p.code, CASE WHEN ia AND ib THEN 'both' WHEN ia THEN 'ours only' ELSE 'theirs only' END AS present_in, x.month, x.diff FROM (
    SELECT code, bool_or(s = 'a') AS ia, bool_or(s = 'b') AS ib FROM (SELECT code, 'a' AS s FROM a UNION ALL SELECT code, 'b' FROM b) GROUP BY 1) p
  LEFT JOIN (SELECT code, month, round(sum(v), 2) AS diff FROM (SELECT code, month, value AS v FROM a UNION ALL SELECT code, month, -value FROM b)
    WHERE month IN (SELECT month FROM a INTERSECT SELECT month FROM b) GROUP BY 1, 2) x USING (code))"""


@query("d27_series_diff", with_(MONTHLY, series_sql("a", "chain0", True), series_sql("b", "chain1", True), DIFF) + "SELECT * FROM d")
def d27(c: Ctx):
    m = monthly(c)
    a, b = (ru.merge_untagged(_series(m, x), ["99", "127"]) for x in ("chain0", "chain1"))
    return ru.series_diff(a, b, "ours", "theirs")


@query("d27_diff_totals", with_(MONTHLY, series_sql("a", "chain0"), series_sql("b", "chain2"), DIFF) + """
SELECT code, present_in, round(coalesce(sum(diff), 0.0), 2) AS total_diff FROM d GROUP BY 1, 2""")
def d27_totals(c: Ctx):
    m = monthly(c)
    return ru.diff_totals(ru.series_diff(_series(m, "chain0"), _series(m, "chain2"), "ours", "theirs"))


@query("d28_group_summary", with_(MONTHLY) + f"""
SELECT partner_group, ref_code, sum(dr) AS dr_usd, grouping(ref_code) = 1 AS is_subtotal FROM (
  SELECT {GROUP_SQL.format(n='ref_code')} AS partner_group, ref_code, sum(dr_usd) AS dr FROM monthly GROUP BY 1, 2)
GROUP BY ROLLUP (partner_group, ref_code) HAVING grouping(partner_group) = 0""")
def d28(c: Ctx):
    return ru.group_summary(monthly(c))


@query("d29_rates_table", with_(MONTHLY, RATES) + f"""
SELECT token, CASE WHEN known THEN code ELSE 'unknown' END AS rate_type, CASE WHEN known THEN apy END AS apy, CASE WHEN known THEN round(reward_per, 10) END AS reward_per FROM (
  SELECT DISTINCT token, token <> 'spETH' AS known, {REWARD_CODE.format(t='token')} AS code FROM monthly)
JOIN rates ON reward_code = code AND DATE '2026-02-01' BETWEEN start_dt AND end_dt""")
def d29(c: Ctx):
    tokens = monthly(c).select("token").distinct()
    coded = tokens.filter("token <> 'spETH'").withColumns({"reward_code": rt.reward_code(F.col("token")), "dt": F.to_date(F.lit("2026-02-01"))})
    tiers = rt.schedule(c.spark)
    match = (coded["reward_code"] == tiers["reward_code"]) & coded["dt"].between(tiers["start_dt"], tiers["end_dt"])
    rates = coded.join(tiers, match).select("token", coded["reward_code"].alias("rate_type"), "apy", F.round("reward_per", 10).alias("reward_per"))
    return ru.rates_table(tokens, rates)


NEW_OLD = """n AS (SELECT ref_code, token, m AS month, sum(dr_usd) AS dr_usd FROM monthly WHERE blockchain = 'chain0' GROUP BY ALL),
o AS (SELECT ref_code, token, m AS month, sum(dr_usd) AS dr_usd FROM monthly WHERE blockchain = 'chain1' GROUP BY ALL)"""


def _cells(c: Ctx, chain: str):
    return monthly(c).filter(F.col("blockchain") == chain).groupBy("ref_code", "token", ru.month_label(F.col("month")).alias("month")).agg(F.sum("dr_usd").alias("dr_usd"))


def _expected(c: Ctx):
    return c.spark.sql("select * from values (99L,'relabelled'), (1L,'relabelled'), (2L,'method') as t(ref_code, reason)")


@query("d30_month_moves", with_(MONTHLY, NEW_OLD) + """
SELECT o.ref_code, o.token, o.month, o.dr_usd AS old_usd, coalesce(n.dr_usd, 0.0) AS new_usd,
  CASE WHEN o.ref_code IN (99, 1) THEN 'relabelled' WHEN o.ref_code = 2 THEN 'method' ELSE 'UNEXPECTED' END AS classification
FROM o LEFT JOIN n USING (ref_code, token, month) WHERE o.ref_code <> 1003 AND abs(o.dr_usd) >= 10
  AND abs(coalesce(n.dr_usd, 0.0) - o.dr_usd) > greatest(25.0, 0.02 * abs(o.dr_usd))""")
def d30_moves(c: Ctx):
    return rc.month_moves(_cells(c, "chain0"), _cells(c, "chain1"), [1003], _expected(c))


@query("d30_quality_checks", with_(MONTHLY, NEW_OLD, "meas AS (SELECT ref_code, m AS month, dr_usd AS delta FROM monthly WHERE blockchain = 'chain0' AND m <= '2029-12')") + """
SELECT 'venue set' AS check_name, CASE WHEN x + y = 0 THEN 'OK' ELSE 'DIFFERS' END AS result, 'only new=' || x || ' only old=' || y AS detail FROM (
  SELECT (SELECT count(*) FROM (SELECT ref_code, token FROM n WHERE ref_code <> 1003 EXCEPT SELECT ref_code, token FROM o)) AS x,
         (SELECT count(*) FROM (SELECT ref_code, token FROM o WHERE ref_code <> 1003 EXCEPT SELECT ref_code, token FROM n)) AS y)
UNION ALL SELECT 'aggregator total 1003', CASE WHEN got BETWEEN want - 1 AND want + 1 THEN 'OK' ELSE 'MISMATCH' END, 'matches' FROM (
  SELECT (SELECT sum(dr_usd) FROM n WHERE ref_code = 1003 AND month <= '2029-12') AS got, (SELECT sum(delta) FROM meas WHERE ref_code = 1003) AS want)
UNION ALL SELECT DISTINCT 'month beyond measurement ' || month, 'UNVERIFIED', 'no independent measurement' FROM n WHERE month > '2029-12'
UNION ALL SELECT 'month moves', CASE WHEN u = 0 THEN 'OK' ELSE 'UNEXPECTED' END, 'moved=' || k || ' unexpected=' || u FROM (
  SELECT count(*) AS k, count(*) FILTER (o.ref_code NOT IN (99, 1, 2)) AS u FROM o LEFT JOIN n USING (ref_code, token, month)
  WHERE o.ref_code <> 1003 AND abs(o.dr_usd) >= 10 AND abs(coalesce(n.dr_usd, 0.0) - o.dr_usd) > greatest(25.0, 0.02 * abs(o.dr_usd)))""")
def d30(c: Ctx):
    new = _cells(c, "chain0")
    measured = new.filter("month <= '2029-12'").select("ref_code", "month", F.col("dr_usd").alias("delta"))
    slack = c.spark.sql("select * from values (1003L, 1.0D) as t(ref_code, slack_usd)")
    out = rc.quality_checks(new, _cells(c, "chain1"), measured, [1003], slack, _expected(c))
    # The amounts inside the text are engine-formatted doubles: compare the verdict.
    is_total = F.col("check_name").startswith("aggregator")
    return out.withColumn("detail", F.when(is_total, F.lit("matches")).otherwise(F.col("detail")))


@query("d30_rate_basis", with_(MONTHLY, RATES) + f"""
SELECT token, m AS month, round(reward_per, 12) AS actual, 'OK' AS result FROM (SELECT DISTINCT token, m, month, {REWARD_CODE.format(t='token')} AS code FROM monthly)
JOIN rates ON reward_code = code AND month BETWEEN start_dt AND end_dt""")
def d30_rates(c: Ctx):
    keys = monthly(c).select("token", ru.month_label(F.col("month")).alias("m"), F.col("month").alias("dt")).distinct()
    tiers = rt.schedule(c.spark)
    wanted = rt.with_daily_rate(keys.withColumn("reward_code", rt.reward_code(F.col("token"))), tiers)
    checked = rc.rate_basis_check(tiers, wanted.select("reward_code", "dt", "reward_per").distinct())
    return keys.withColumn("reward_code", rt.reward_code(F.col("token"))).join(checked, ["reward_code", "dt"]).select(
        "token", F.col("m").alias("month"), F.round("actual", 12).alias("actual"), "result")


PAID = f"""paid AS (SELECT ref_code, m AS month, floor(sum(dr_usd) / 100.0) * 100.0 AS paid_usd FROM monthly WHERE m BETWEEN '2026-02' AND '2026-06' AND ref_code IN (1, 2, 3) GROUP BY ALL),
codes AS (SELECT * FROM (VALUES (1, 'one'), (2, 'two'), (3, 'three'), (99, 'memo')) AS t(ref_code, partner)),
lines AS (SELECT g.month, c.ref_code, c.partner, round(coalesce(x.calc, 0.0), 2) AS calculated_dr_usd, p.paid_usd AS paid_dr_usd,
    round(p.paid_usd - round(coalesce(x.calc, 0.0), 2), 2) AS diff_paid_minus_calc
  FROM codes c CROSS JOIN (SELECT unnest([{', '.join(repr(m) for m in _YEAR)}]) AS month) g
  LEFT JOIN (SELECT ref_code, m AS month, sum(dr_usd) AS calc FROM monthly GROUP BY ALL) x ON x.ref_code = c.ref_code AND x.month = g.month
  LEFT JOIN paid p ON p.ref_code = c.ref_code AND p.month = g.month)"""


def payment_lines(c: Ctx, months=_YEAR, uncovered: str = "fail"):
    m = monthly(c)
    label = ru.month_label(F.col("month"))
    paid = m.filter(label.between("2026-02", "2026-06") & F.col("ref_code").isin(1, 2, 3)).groupBy("ref_code", label.alias("month")).agg(
        (F.floor(F.sum("dr_usd") / F.lit(100.0)).cast("double") * F.lit(100.0)).alias("paid_usd"))
    codes = c.spark.sql("select * from values (1L,'one'), (2L,'two'), (3L,'three'), (99L,'memo') as t(ref_code, partner)")
    return rc.reconcile_payments(m, paid, codes, months, uncovered)


@query("d31_reconcile_payments", with_(MONTHLY, PAID) + "SELECT * FROM lines")
def d31(c: Ctx):
    return payment_lines(c)


_LATER = [*LEDGER_MONTHS[-4:], "2030-12", "2031-01"]  # the last months of the ledger, and two that it does not reach


@query("d31_uncovered_months", with_(MONTHLY, PAID.replace(repr(_YEAR)[1:-1], repr(_LATER)[1:-1])) + """
SELECT month, ref_code, partner, CASE WHEN month <= (SELECT max(m) FROM monthly) THEN calculated_dr_usd END AS calculated_dr_usd, paid_dr_usd,
  CASE WHEN month <= (SELECT max(m) FROM monthly) THEN diff_paid_minus_calc END AS diff_paid_minus_calc FROM lines""")
def d31_uncovered(c: Ctx):
    return payment_lines(c, _LATER, uncovered="null")


@query("d31_payment_summary", with_(MONTHLY, PAID) + """
SELECT ref_code, partner, round(sum(CASE WHEN month < '2026-02' THEN calculated_dr_usd ELSE 0 END), 2) AS calc_before,
  round(sum(CASE WHEN month BETWEEN '2026-02' AND '2026-06' THEN calculated_dr_usd ELSE 0 END), 2) AS calc_window, round(sum(paid_dr_usd), 2) AS paid_window,
  round(sum(CASE WHEN month > '2026-06' THEN calculated_dr_usd ELSE 0 END), 2) AS calc_unpaid,
  round(round(sum(paid_dr_usd), 2) - round(sum(CASE WHEN month BETWEEN '2026-02' AND '2026-06' THEN calculated_dr_usd ELSE 0 END), 2), 2) AS diff
FROM lines GROUP BY 1, 2""")
def d31_summary(c: Ctx):
    return rc.payment_summary(payment_lines(c))


@query("d33_twa_parity", with_(FULL_TWA) + """
SELECT count(*) AS matched, CAST(0 AS BIGINT) AS only_ours, CAST(0 AS BIGINT) AS only_theirs, count(*) AS within_tol, CAST(0 AS BIGINT) AS day_type_mismatches,
  count(*) FILTER (day_type = 'transaction_day') AS tx_rows, count(*) FILTER (day_type = 'transaction_day') AS duration_exact FROM daily""")
def d33(c: Ctx):
    # Two independent leg layouts of the same transfers must agree on every key.
    from tideledger.operators import attribution as at, legs as lg

    per_transfer = lg.transfer_legs(c.tr, at.merge_codes(*c.code_maps), c.targets)
    out = rc.twa_parity(full(c), daily_twa(per_transfer, FILL))
    return out.select("matched", "only_ours", "only_theirs", "within_tol", "day_type_mismatches", "tx_rows", "duration_exact")


@query("d34_series_parity", with_(MONTHLY, NEW_OLD) + """
SELECT token, count(*) FILTER (a AND b) AS matched, count(*) FILTER (a AND NOT b) AS only_ours, count(*) FILTER (b AND NOT a) AS only_theirs,
  max(abs(x - y)) AS max_abs_diff, max(abs(x - y) / greatest(abs(y), 1e-18)) AS max_rel_diff FROM (
  SELECT coalesce(n.token, o.token) AS token, n.token IS NOT NULL AS a, o.token IS NOT NULL AS b, n.dr_usd AS x, o.dr_usd AS y
  FROM n FULL JOIN o ON n.ref_code = o.ref_code AND n.token = o.token AND n.month = o.month) GROUP BY 1""")
def d34(c: Ctx):
    return rc.series_parity(_cells(c, "chain0"), _cells(c, "chain1"), ["ref_code", "token", "month"], "dr_usd", ["token"])


@query("d35_month_diff", with_(LEDGER) + f"""
, f AS (SELECT blockchain, {day('ts')} AS dt, symbol AS token, CAST(sum(amount_change) AS DOUBLE) AS amount FROM legs WHERE {day('ts')} BETWEEN DATE '2026-03-01' AND DATE '2026-03-31' GROUP BY ALL),
x AS (SELECT coalesce(a.dt, b.dt) AS dt, coalesce(a.token, b.token) AS token, a.amount AS amount_ours, b.amount AS amount_theirs,
  coalesce(a.amount, 0) - coalesce(b.amount, 0) AS delta, CASE WHEN b.amount IS NULL OR b.amount = 0 THEN NULL ELSE (coalesce(a.amount, 0) - b.amount) / b.amount * 100.0 END AS delta_pct
  FROM (SELECT * FROM f WHERE blockchain = 'chain0') a FULL JOIN (SELECT * FROM f WHERE blockchain = 'chain1') b ON a.dt = b.dt AND a.token = b.token)
SELECT * FROM x WHERE abs(delta) > 1""")
def d35(c: Ctx):
    per = lambda chain: c.ledger.filter(F.col("blockchain") == chain).groupBy(
        day_of(F.col("ts")).alias("dt"), F.col("symbol").alias("token")).agg(F.sum("amount_change").cast("double").alias("amount"))
    return rc.month_diff(per("chain0"), per("chain1"), "2026-03", ["dt", "token"])


@query("d32_verify_payments", with_(EV, TR) + """
SELECT p.tx_hash, p.label, t.contract_address, t.block_time, t.from_addr, t.to_addr, t.amount, n.s_name AS recipient_label, t.from_addr IS NOT NULL AS found
FROM (SELECT tx_hash, 'large' AS label FROM ev WHERE cents > 15000 UNION ALL SELECT 'missing' || s_suppkey, 'never sent' FROM supplier) p
LEFT JOIN (SELECT * FROM tr WHERE amount >= 100) t USING (tx_hash) LEFT JOIN supplier n ON 'u' || n.s_suppkey = t.to_addr""")
def d32(c: Ctx):
    s = c.table("supplier")
    payments = c.ev.filter("cents > 15000").select("tx_hash", F.lit("large").alias("label")).union(
        s.select(F.concat(F.lit("missing"), F.col("s_suppkey")), F.lit("never sent")))
    labels = s.select(F.concat(F.lit("u"), F.col("s_suppkey")).alias("address"), F.col("s_name").alias("recipient_label"))
    return rc.verify_payments(payments, c.tr, labels, 100)
