"""Time-weighted balances against a second-by-second reading of the definition."""

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import CHAIN, DAY, LEG_SCHEMA, TOKEN
from tideledger.functions.labels import UNTAGGED
from tideledger.operators import monthly as mo
from tideledger.operators.twa import (
    balance_intervals, daily_snapshots, daily_twa, running_state, to_daily, windowed_daily,
)

EPOCH = date(1970, 1, 1)


def make_legs(seed, users=6, per_user=25, days=9, hot=0):
    rnd, rows = random.Random(seed), []
    for u in range(users):
        n = per_user if u else per_user + hot
        times = sorted(rnd.choice([rnd.randrange(days * 86400), 86400 * rnd.randrange(days)]) for _ in range(n))
        for i, t in enumerate(times):
            code = rnd.choice([None, None, None, 1, 2, 0])
            rows.append((CHAIN, TOKEN, "sUSDS", f"u{u}", 1000 + t // 12, i, rnd.randrange(2), DAY + t, float(rnd.randrange(-40, 60)), code))
    return rows


def by_definition(rows, fill_through):
    """Overlap of every constant state with every day, one state at a time."""
    out = {}
    per_user = defaultdict(list)
    for r in rows:
        per_user[r[3]].append(r)
    for user, legs in per_user.items():
        legs.sort(key=lambda r: (r[4], r[5], r[6]))
        states, bal, code = [], 0.0, UNTAGGED
        for r in legs:
            bal += r[8]
            code = r[9] if r[9] is not None else code
            states.append((r[7], bal, code))
        last_day = EPOCH + timedelta(days=states[-1][0] // 86400)
        stop = max(last_day, fill_through) if bal > 1e-9 else last_day
        end = ((stop - EPOCH).days + 1) * 86400
        tx_days = {s[0] // 86400 for s in states}
        for (t, b, c), nxt in zip(states, [s[0] for s in states[1:]] + [end]):
            while t < nxt:
                day = t // 86400
                upto = min(nxt, (day + 1) * 86400)
                key = (user, EPOCH + timedelta(days=day), c)
                held, prod, _ = out.get(key, (0, 0.0, False))
                out[key] = (held + upto - t, prod + b * (upto - t), day in tx_days)
                t = upto
    return {k: (v[1] / 86400, v[2], v[0]) for k, v in out.items() if v[1] > 0}


def as_dict(df):
    return {(r["user_addr"], r["dt"], r["ref_code"]): (r["time_weighted_avg_balance"], r["day_type"] == "transaction_day",
                                                      r["segment_duration_seconds"] if r["day_type"] == "transaction_day" else 86400)
            for r in df.collect()}


@pytest.mark.parametrize("seed,slot", [(1, 3600), (2, 86400), (3, 900)])
def test_matches_definition(spark, seed, slot):
    rows = make_legs(seed)
    fill = date(2025, 1, 14)
    got = as_dict(daily_twa(spark.createDataFrame(rows, LEG_SCHEMA), fill, slot_seconds=slot))
    want = by_definition(rows, fill)
    # The untagged head of a first day covers no balance; durations of other rows are exact.
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == pytest.approx(want[k][0], rel=1e-12)
        assert got[k][1] == want[k][1]
        if k[2] != UNTAGGED:
            assert got[k][2] == want[k][2]


def test_hot_wallet_split_over_slots(spark):
    """One wallet with most rows: the heavy step never groups by wallet alone."""
    rows = make_legs(5, users=4, per_user=20, hot=3000)
    legs = spark.createDataFrame(rows, LEG_SCHEMA)
    fill = date(2025, 1, 12)
    got, want = as_dict(daily_twa(legs, fill)), by_definition(rows, fill)
    assert got.keys() == want.keys()
    assert all(got[k][0] == pytest.approx(want[k][0], rel=1e-9) for k in want)
    plan = daily_twa(legs, fill)._jdf.queryExecution().executedPlan().toString()
    first_shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("slot" in line for line in first_shuffles)


def test_running_state_matches_plain_window(spark):
    from pyspark.sql import Window

    legs = spark.createDataFrame(make_legs(6, hot=400), LEG_SCHEMA)
    w = Window.partitionBy("user_addr").orderBy("block", "log_index", "leg_seq").rowsBetween(Window.unboundedPreceding, 0)
    plain = legs.select("user_addr", "block", "log_index", "leg_seq", F.sum("amount_change").over(w).alias("running_balance"),
                        F.coalesce(F.last("ref_code", True).over(w), F.lit(UNTAGGED)).alias("current_ref_code"))
    split = running_state(legs).select(*plain.columns)
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()


def test_windows_put_together_equal_one_run(spark):
    legs = spark.createDataFrame(make_legs(7), LEG_SCHEMA)
    cuts = [date(2025, 1, 1), date(2025, 1, 3), date(2025, 1, 4), date(2025, 1, 8), date(2025, 1, 15)]
    cols = ["user_addr", "dt", "ref_code", "time_weighted_avg_balance"]
    parts = [windowed_daily(legs, a, b).select(*cols) for a, b in zip(cuts, cuts[1:])]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    whole = daily_twa(legs, date(2025, 1, 14)).select(*cols)
    assert whole.exceptAll(union).isEmpty() and union.exceptAll(whole).isEmpty()


def test_full_days_cover_86400_seconds(spark):
    iv = balance_intervals(spark.createDataFrame(make_legs(8), LEG_SCHEMA), date(2025, 1, 14))
    days = iv.filter("day_type = 'transaction_day'").groupBy("user_addr", "start_dt").agg(F.sum("dur").alias("s"))
    assert {r["s"] for r in days.collect()} == {86400}
    assert to_daily(iv).filter("day_type = 'no_transaction_day' and segment_duration_seconds is not null").isEmpty()


def test_fill_policies(spark):
    rows = [(CHAIN, TOKEN, "sUSDS", "gone", 1, 1, 0, DAY, 5.0, None), (CHAIN, TOKEN, "sUSDS", "gone", 2, 1, 0, DAY + 3 * 86400, -5.0, None)]
    legs = spark.createDataFrame(rows, LEG_SCHEMA)
    trimmed = balance_intervals(legs, date(2025, 1, 10)).agg(F.max("end_dt")).first()[0]
    always = balance_intervals(legs, date(2025, 1, 10), fill="always").agg(F.max("end_dt")).first()[0]
    assert (trimmed, always) == (date(2025, 1, 4), date(2025, 1, 10))


def test_interval_amounts_equal_daily_amounts(spark):
    iv = balance_intervals(spark.createDataFrame(make_legs(9), LEG_SCHEMA), date(2025, 1, 14))
    key = lambda r: (r["dt"], r["token"], r["ref_code"])
    a = {key(r): r["amount"] for r in mo.interval_amounts(iv, mo.reclass_savings).collect()}
    b = {key(r): r["amount"] for r in mo.daily_amounts(to_daily(iv), mo.reclass_savings).collect()}
    assert a.keys() == b.keys()
    assert all(a[k] == pytest.approx(b[k], rel=1e-9) for k in b)


def test_snapshots_carry_forward(spark):
    rows = [(CHAIN, TOKEN, "USDS", "h", 1, 1, 0, DAY + 86400, 5.0, 9001), (CHAIN, TOKEN, "USDS", "h", 2, 1, 0, DAY + 3 * 86400, -2.0, 9001)]
    snap = daily_snapshots(spark.createDataFrame(rows, LEG_SCHEMA), date(2025, 1, 1), date(2025, 1, 6), ["user_addr"])
    assert [r["balance"] for r in snap.orderBy("dt").collect()] == [0.0, 5.0, 5.0, 3.0, 3.0, 3.0]


def test_slot_must_divide_day(spark):
    with pytest.raises(ValueError):
        daily_twa(spark.createDataFrame(make_legs(1), LEG_SCHEMA), date(2025, 1, 2), slot_seconds=7000)
