"""Carried state: windows read one snapshot and their own legs, states merge in any order, late legs reach every state they belong to."""

from datetime import date
from itertools import permutations

import pytest
from helpers import CHAIN, DAY, LEG_SCHEMA, TOKEN
from pyspark.sql import functions as F
from test_scan import metric

from tideledger.operators import state as st
from tideledger.operators.twa import daily_twa

D = [date(2025, 1, n) for n in (1, 4, 7, 10)]


def leg(user, day, amount, code=None, block=None, li=0, second=0):
    ts = DAY + day * 86400 + second
    return (CHAIN, TOKEN, "tok", user, block if block is not None else ts // 12, li, 0, ts, float(amount), code)


LEGS = [
    leg("a", 0, 10, 5), leg("a", 4, 5), leg("a", 8, -15, 6),          # holds through every window
    leg("b", 0, 3, 7), leg("b", 1, -3), leg("b", 7, 4),                # leaves, and comes back under the code it had
    leg("c", 2, 1e-12), leg("d", 5, 2, second=100), leg("d", 5, 1, 9, li=1, second=100),
    leg("e", 1, 8, 1), leg("e", 1, -8),                                 # never seen again
]


@pytest.fixture()
def legs(spark):
    return spark.createDataFrame(LEGS, LEG_SCHEMA)


def rows(df):
    return sorted((r["user_addr"], str(r["dt"]), r["ref_code"], round(r["time_weighted_avg_balance"], 9)) for r in df.collect())


def test_chained_windows_equal_one_run(legs, tmp_path):
    got = []
    for i, (a, b) in enumerate(zip(D, D[1:])):
        got += rows(st.advance(legs, str(tmp_path), a, b, genesis=i == 0))
    assert sorted(got) == rows(daily_twa(legs, date(2025, 1, 9)))


def test_a_window_reads_its_own_files_and_one_state(spark, legs, tmp_path):
    path, root = str(tmp_path / "legs"), str(tmp_path / "state")
    legs.withColumn("day", F.floor(F.col("ts") / 86400)).repartition(1, "day").sortWithinPartitions("ts").write.partitionBy("day").parquet(path)
    st.advance(legs, root, D[0], D[1], genesis=True)
    days = [(d - date(1970, 1, 1)).days for d in D]
    stored = spark.read.parquet(path).filter(F.col("day").between(days[1], days[2] - 1)).drop("day")
    window = st.opened_legs(st.read_state(spark, root, D[1]), st.of_window(stored, D[1], D[2]), D[1])
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThanOrEqual(ts,{days[1] * 86400})" in plan and f"LessThan(ts,{days[2] * 86400})" in plan and "PartitionFilters: [isnotnull(day" in plan
    mine = st.of_window(stored, D[1], D[2])
    assert metric(mine, "numFiles") == 2 < metric(spark.read.parquet(path), "numFiles") == 7
    assert len({f.split("attempt=")[1][:32] for f in window.inputFiles() if "attempt=" in f}) == 1


def test_merge_is_associative_and_commutative(legs):
    parts = [st.partial_state(legs.filter(F.pmod(F.hash("block", "log_index"), F.lit(3)) == i)) for i in range(3)]
    want = sorted(map(tuple, st.partial_state(legs).collect()))
    for x, y, z in permutations(parts):
        assert sorted(map(tuple, st.merge_states(st.merge_states(x, y), z).collect())) == want
    assert sorted(map(tuple, st.merge_states(parts[0], st.merge_states(parts[1], parts[2])).collect())) == want
    plan = st.merge_states(*parts)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Window" not in plan


def test_late_legs_reach_every_later_state(spark, legs, tmp_path):
    root = str(tmp_path)
    missing = (F.col("user_addr") == "a") & (F.col("ts") == DAY + 4 * 86400)
    for i, (a, b) in enumerate(zip(D, D[1:])):
        st.advance(legs.filter(~missing), root, a, b, genesis=i == 0)
    assert st.apply_late(legs.filter(missing), root) == D[2:]
    got = sorted(map(tuple, st.read_state(spark, root, D[3]).collect()))
    assert got == sorted(map(tuple, st.partial_state(legs).collect()))
    assert rows(st.advance(legs, root, D[2], D[3])) == [r for r in rows(daily_twa(legs, date(2025, 1, 9))) if r[1] >= "2025-01-07"]
    assert st.apply_late(legs.limit(0), root) == []


def test_a_missing_state_is_an_error(legs, tmp_path):
    with pytest.raises(ValueError, match="missing"):
        st.advance(legs, str(tmp_path), D[1], D[2])
