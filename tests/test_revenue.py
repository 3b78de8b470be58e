"""Rates, code rules and the reward formula."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tideledger.functions.labels import NON_PAYABLE_CODES
from tideledger.operators import conversion as cv, monthly as mo, rates as rt, reconcile as rc

# Locked daily rates.
LOCKED = [
    ("XR", "2026-01-01", 4.987575587290e-03),
    ("XR*", "2026-01-01", 1.998008131217e-03),
    ("XR-stUSDS", "2026-01-01", 9.995017016051e-04),
    ("XR", "2024-06-01", 5.982120698627e-03),
    ("XR-stUSDS", "2025-12-31", 5.982120698627e-03),
    ("XR", "2026-07-08", 4.987575587290e-03),
    ("XR", "2026-07-09", 1.998008131217e-03),
    ("XR*", "2026-07-09", 1.998008131217e-03),
    ("XR-stUSDS", "2026-07-09", 9.995017016051e-04),
]
TWA = ("blockchain string, contract_address string, symbol string, user_addr string, dt date, ref_code bigint, "
       "time_weighted_avg_balance double")


def twa(spark, *rows):
    return spark.createDataFrame([("ethereum", "0xt", s, u, date.fromisoformat(d), c, 100.0) for s, u, d, c in rows], TWA)


def rewards(spark, df, rule, **kw):
    out = mo.monthly_rewards(mo.daily_rewards(mo.daily_amounts(df, rule), rt.schedule(spark), **kw))
    return {(r["token"], r["ref_code"]): r["dr_usd"] for r in out.collect()}


def test_locked_rates(spark):
    asked = spark.createDataFrame([(c, date.fromisoformat(d), v) for c, d, v in LOCKED], "reward_code string, dt date, reward_per double")
    checked = rc.rate_basis_check(rt.schedule(spark), asked)
    for r in checked.collect():
        assert r["actual"] == pytest.approx(r["expected"], rel=1e-12)


def test_day_without_tier(spark):
    days = spark.createDataFrame([("XR", date(2031, 1, 1))], "reward_code string, dt date")
    assert rt.with_daily_rate(days, rt.schedule(spark)).first()["reward_per"] == 0.0
    assert rt.with_daily_rate(days, rt.schedule(spark), "drop").isEmpty()


def test_reward_codes(spark):
    tokens = spark.createDataFrame([("stUSDS",), ("sUSDC",), ("spETH",), ("new",)], "t string")
    got = {r["t"]: r["c"] for r in tokens.select("t", rt.reward_code(F.col("t")).alias("c")).collect()}
    assert got == {"stUSDS": "XR-stUSDS", "sUSDC": "XR", "spETH": "XR*", "new": "XR"}


def test_reclass_and_formula(spark):
    df = twa(spark, ("sUSDS", "u1", "2026-02-01", 5), ("sUSDS", "u2", "2026-02-01", -999999), ("sUSDS", "u2", "2026-02-02", -999999))
    conv = spark.sql("select explode(array(date'2026-02-01', date'2026-02-02')) dt, 2.0D rate")
    got = rewards(spark, df, mo.reclass_savings, conversion=conv)
    one = 100.0 / 365 * 4.987575587290e-03 * 2.0
    assert got.keys() == {("sUSDS", 5), ("sUSDS", 99)}
    assert got[("sUSDS", 5)] == pytest.approx(one, rel=1e-10)
    assert got[("sUSDS", 99)] == pytest.approx(2 * one, rel=1e-10)


def test_vault_rules(spark):
    df = twa(spark, ("spUSDT", "u", "2026-02-01", -999999), ("spETH", "u", "2026-02-01", 5), ("spUSDC", "u", "2026-02-01", 127))
    none = spark.createDataFrame([], "blockchain string, vault_symbol string, dt date, deployment_ratio double")
    got = rewards(spark, df, mo.reclass_vaults, ratios=none)
    assert got[("spUSDT", 130)] == pytest.approx(100.0 / 365 * 1.998008131217e-03, rel=1e-10)
    assert got[("spETH", 5)] == 0.0
    assert got[("spUSDC", 131)] == 0.0  # no ratio for the day counts as 0


def test_l2_split(spark):
    df = twa(spark, ("sUSDS", "0xA1", "2026-02-01", 0), ("sUSDS", "0xb2", "2026-02-01", 0), ("sUSDS", "c", "2026-02-01", -999999))
    got = rewards(spark, df, mo.reclass_l2({"ethereum": ("0xa1",)}))
    assert set(got) == {("sUSDS", 10001), ("sUSDS", 10000), ("sUSDS", 99)}


def test_non_payable_registry():
    assert set(NON_PAYABLE_CODES) == {-999999, 99, 127, 10000, 10001}
    assert not set(NON_PAYABLE_CODES) & {1003, 1004, 4011, 9001, 4001, 130, 131, 132, 0, 1, 128, 197, 1001, 1002, 1007, 1016}


def test_conversion_series_fills(spark):
    d = 86400 * 20000
    flows = spark.createDataFrame(
        [("c", "v", d + 10, 2, 3.0, 2.0), ("c", "v", d + 10, 5, 8.0, 4.0), ("c", "v", d + 9, 9, 9.0, 1.0), ("c", "v", d + 20, 1, 1.0, 0.0),
         ("c", "v", d + 3 * 86400, 1, 5.0, 2.0)], "blockchain string, contract_address string, block_time bigint, log_index bigint, assets double, shares double")
    first = date(1970, 1, 1).fromordinal(date(1970, 1, 1).toordinal() + 19999)
    starts = spark.createDataFrame([("c", "v", first)], "blockchain string, contract_address string, start_dt date")
    end = first.fromordinal(first.toordinal() + 6)
    got = [r["rate"] for r in cv.conversion_series(flows, starts, end).orderBy("dt").collect()]
    assert got == [1.0, 2.0, 2.0, 2.0, 2.5, 2.5, 2.5]


def test_ratio_bounds(spark):
    totals = spark.sql("select * from values ('e','spUSDC',date'2026-01-01',100D), ('e','spUSDT',date'2026-01-01',100D), ('e','spUSDC',date'2026-01-02',100D) as t(blockchain,vault_symbol,dt,vault_total_supply)")
    idle = spark.sql("select * from values ('e','spUSDC',date'2026-01-01',130D), ('e','spUSDT',date'2026-01-01',50D) as t(blockchain,vault_symbol,dt,idle)")
    got = {(r["vault_symbol"], str(r["dt"])): r["deployment_ratio"] for r in mo.deployment_ratios(totals, idle).collect()}
    assert got == {("spUSDC", "2026-01-01"): 0.0, ("spUSDT", "2026-01-01"): 1.0, ("spUSDC", "2026-01-02"): 1.0}


def _slice_frame(spark, rows):
    return spark.createDataFrame(rows, "source string, slice_start string, slice_end string")


def test_combine_fails_on_a_gap(spark):
    from tideledger.operators import rollup as ru

    part = spark.sql("select date'2025-01-01' as month, 1.0D as dr_usd")
    whole = _slice_frame(spark, [("a", "2025-01-01", "2025-03-01"), ("a", "2025-03-01", "2025-04-01"), ("b", "2025-01-01", "2025-04-01")])
    assert ru.combine({"a": part, "b": part}, whole, "2025-01-01", "2025-04-01").count() == 2
    for bad, told in (([("a", "2025-01-01", "2025-02-01"), ("a", "2025-03-01", "2025-04-01")], "gap 2025-02-01 to 2025-03-01"),
                      ([("a", "2025-01-01", "2025-03-15")], "short 2025-03-15 to 2025-04-01"),
                      ([("a", "2025-01-01", "2025-03-15"), ("a", "2025-03-01", "2025-04-01")], "overlap 2025-03-01 to 2025-03-15")):
        with pytest.raises(Exception, match=told):
            ru.combine({"a": part}, _slice_frame(spark, bad), "2025-01-01", "2025-04-01").count()
    late = _slice_frame(spark, [("a", "2025-01-01", "2025-03-01")])
    assert ru.combine({"a": part}, late, "2025-01-01", "2025-04-01", tolerate_after="2025-03-01").count() == 1   # the rest has not happened yet
    assert [r["problem"] for r in rc.coverage_problems(late.filter("false"), "2025-01-01", "2025-04-01").collect()] == ["short"]


def test_uncovered_months_fail(spark):
    monthly = spark.sql("select date'2026-01-01' as month, 1L as ref_code, 5.0D as dr_usd union all select date'2026-02-01', 1L, 6.0D")
    paid = spark.sql("select 1L as ref_code, '2026-03' as month, 7.0D as paid_usd")
    codes = spark.sql("select 1L as ref_code, 'p' as partner union all select 2L, 'q'")
    with pytest.raises(Exception, match="month not covered by the calculated rewards: 2026-03"):
        rc.reconcile_payments(monthly, paid, codes, ["2026-02", "2026-03"]).collect()
    got = {(r["ref_code"], r["month"]): (r["calculated_dr_usd"], r["diff_paid_minus_calc"])
           for r in rc.reconcile_payments(monthly, paid, codes, ["2026-02", "2026-03"], uncovered="null").collect()}
    assert got == {(1, "2026-02"): (6.0, None), (2, "2026-02"): (0.0, None), (1, "2026-03"): (None, None), (2, "2026-03"): (None, None)}


def test_schedule_keeps_the_highest_priority(spark):
    from datetime import date as d

    rows = [("X", "fixed", d(2025, 1, 1), d(2025, 1, 31), 0.1, 1), ("X", "seen", d(2025, 1, 5), d(2025, 1, 9), 0.2, 2), ("X", "seen", d(2025, 1, 8), d(2025, 1, 12), 0.3, 2),
            ("X", "campaign", d(2025, 1, 10), d(2025, 1, 10), 0.4, 3), ("Y", "fixed", d(2025, 1, 1), d(2025, 1, 2), 0.5, 1), ("Y", "fixed", d(2025, 1, 4), d(2025, 1, 4), 0.6, 1)]
    df = spark.createDataFrame(rows, "reward_code string, reward_description string, start_dt date, end_dt date, reward_per double, priority int")
    got = sorted((r["reward_code"], r["start_dt"].day, r["end_dt"].day, r["reward_per"]) for r in rt.resolved(df).collect())
    assert got == [("X", 1, 4, 0.1), ("X", 5, 7, 0.2), ("X", 8, 9, 0.3), ("X", 10, 10, 0.4), ("X", 11, 12, 0.3), ("X", 13, 31, 0.1), ("Y", 1, 2, 0.5), ("Y", 4, 4, 0.6)]


def test_no_window_of_the_operators_is_unpartitioned():
    from pathlib import Path

    import tideledger.operators as ops

    for file in Path(ops.__path__[0]).glob("*.py"):
        assert "Window.orderBy" not in file.read_text(), file
