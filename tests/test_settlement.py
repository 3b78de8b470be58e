"""Raw logs of registered contracts to monthly rewards, and stored parts."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import DAY, UNIT, ZERO, topic, word
from tideledger.functions import codec
from tideledger.plans import settlement as se
from tideledger.sources import logs as lo, store
from tideledger.sources.registry import EXCLUDED_HOLDERS, SETTLEMENT_PROGRAM, SOURCES, TARGETS

SUSDS = next(t for t in TARGETS if t.source == "susds_eth")
L2 = next(t for t in TARGETS if t.source == "susds_psm3" and t.blockchain == "base")
FARM = next(t for t in TARGETS if t.symbol == "USDS-SKY")
VAULT = next(t for t in TARGETS if t.symbol == "spUSDC" and t.blockchain == "ethereum")
AAVE = next(t for t in TARGETS if t.source == "usds_aave")
A, B, R = ("0x" + c * 40 for c in "abc")
PROGRAM = SETTLEMENT_PROGRAM.contracts[0]
USDC = "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48"
SEP = 1759276800  # 2025-10-01, after every vault start


def log(chain, address, block, li, ts, topic0, topics, words, tx):
    t = topics + [None] * (3 - len(topics))
    return (chain, block, li, ts, address, topic0, *t, "0x" + "".join(words), tx)


def transfer(target, li, ts, frm, to, amount, tx, address=None, decimals=None):
    units = int(amount * 10 ** (decimals or target.decimals))
    return log(target.blockchain, address or target.address, ts // 12, li, ts, codec.TRANSFER_TOPIC, [topic(frm), topic(to)], [word(units)], tx)


@pytest.fixture(scope="module")
def logs(spark):
    rows = [
        # savings token: delivery to A, then a real code; B untagged; an excluded holder
        transfer(SUSDS, 1, DAY, PROGRAM, A, 100, "s1"),
        transfer(SUSDS, 2, DAY, ZERO, B, 50, "s2"),
        transfer(SUSDS, 3, DAY, ZERO, EXCLUDED_HOLDERS[1], 1000, "s3"),
        transfer(SUSDS, 1, DAY + 86400, ZERO, A, 50, "s4"),
        log("ethereum", SUSDS.address, (DAY + 86400) // 12, 2, DAY + 86400, codec.REFERRAL_TOPIC, ["0x" + word(777), topic(A)], [], "s4"),
        log("ethereum", SUSDS.address, (DAY + 86400) // 12, 9, DAY + 86400, codec.DEPOSIT_TOPIC, [topic(A), topic(A)], [word(11 * UNIT), word(10 * UNIT)], "s4"),
        # swap chain
        transfer(L2, 1, DAY, ZERO, A, 10, "l1"),
        log("base", L2.swap_contract, DAY // 12, 2, DAY, codec.SWAP_TOPIC, [topic(B), topic(L2.address), topic(A)], [word(1), word(1), word(0)], "l1"),
        # farm
        log("ethereum", FARM.address, DAY // 12, 5, DAY, codec.STAKED_TOPIC, [topic(A)], [word(30 * UNIT)], "f1"),
        log("ethereum", FARM.address, DAY // 12, 6, DAY, codec.STAKE_REFERRAL_TOPIC, ["0x" + word(12), topic(A)], [word(30 * UNIT)], "f1"),
        log("ethereum", FARM.address, (DAY + 86400) // 12, 5, DAY + 86400, codec.WITHDRAWN_TOPIC, [topic(A)], [word(30 * UNIT)], "f2"),
        # vault with a quarter of its supply idle
        transfer(VAULT, 1, SEP, ZERO, A, 400, "v1"),
        transfer(VAULT, 2, SEP, B, VAULT.address, 100, "v1", address=USDC, decimals=6),
        # contract-held balance
        transfer(AAVE, 1, DAY, A, AAVE.holder, 100, "h1"),
        transfer(AAVE, 2, DAY + 43200, AAVE.holder, A, 40, "h2"),
        transfer(AAVE, 3, DAY + 50000, AAVE.holder, AAVE.holder, 5, "h3"),
    ]
    return spark.createDataFrame(rows, lo.LOG_SCHEMA)


def daily(logs, source, end=date(2025, 1, 4)):
    return {(r["user_addr"], str(r["dt"]), r["ref_code"]): r["time_weighted_avg_balance"]
            for r in se.source_daily(logs, source, end).collect()}


def test_transfer_source(logs):
    got = daily(logs, "susds_eth")
    assert got == {
        (A, "2025-01-01", 1003): 100.0, (A, "2025-01-02", 777): 150.0, (A, "2025-01-03", 777): 150.0,
        **{(B, f"2025-01-0{d}", -999999): 50.0 for d in (1, 2, 3)},
    }
    plain = se.source_daily(logs, "susds_eth", date(2025, 1, 4), include_programs=False)
    assert plain.filter("ref_code = 1003").isEmpty()


def test_stake_and_swap_and_holder_sources(logs):
    assert daily(logs, "usds_farms") == {(A, "2025-01-01", 12): 30.0}
    assert daily(logs, "susds_psm3")[(A, "2025-01-03", 0)] == 10.0
    held = daily(logs, "usds_aave", date(2025, 1, 3))
    assert held == {(AAVE.holder, "2025-01-01", 9001): 80.0, (AAVE.holder, "2025-01-02", 9001): 60.0}


def test_scan_end_is_exclusive(logs):
    assert daily(logs, "usds_aave", date(2025, 1, 1)) == {}


def test_savings_family_prices_shares(logs):
    got = {r["ref_code"]: r["dr_usd"] for r in se.family_monthly(logs, "susds_susdc", date(2025, 1, 4)).collect()}
    unit = 5.982120698627e-03 / 365
    assert got[1003] == pytest.approx(100 * unit, rel=1e-9)                # before the first rate: 1.0
    assert got[777] == pytest.approx(2 * 150 * 1.1 * unit, rel=1e-9)       # 11 assets per 10 shares
    assert got[99] == pytest.approx(50 * (1 + 2 * 1.1) * unit, rel=1e-9)


def test_vault_family_uses_ratio(logs):
    got = se.family_monthly(logs, "sp", date(2025, 10, 2)).collect()
    assert [(r["token"], r["ref_code"]) for r in got] == [("spUSDC", 131)]
    assert got[0]["dr_usd"] == pytest.approx(400 * 0.75 / 365 * 5.982120698627e-03, rel=1e-9)


def test_l2_family_splits_default_code(logs):
    got = {r["ref_code"] for r in se.family_monthly(logs, "psm3", date(2025, 1, 4)).collect()}
    assert got == {10000}


def test_plan_covers_every_target_once(spark):
    rows = se.plan_frame(spark).collect()
    assert len(rows) == len({(r["source"], r["target"]) for r in rows}) == len(TARGETS)
    assert {s for f in se.FAMILIES.values() for s in f.sources} == set(SOURCES)


def _results(spark):
    return spark.sql("""select * from values
        (date'2026-01-01','ethereum','sUSDS',99L,1.0D,'a','t1'), (date'2026-01-01','ethereum','sUSDS',99L,1.0D,'a','t2'),
        (date'2026-01-01','ethereum','stUSDS',5L,3.0D,'b','t3') as t(month,blockchain,token,ref_code,dr_usd,source,target)""")


def test_strict_load_and_resume(spark, tmp_path):
    root, end = str(tmp_path / "parts"), date(2026, 7, 1)
    results = _results(spark)
    plan = results.select("source", "target")
    computed = []

    def compute(todo):
        rows = results.join(todo.select("source", "target"), ["source", "target"], "left_semi")
        computed.append(sorted(r["target"] for r in rows.collect()))
        return rows

    store.resume(spark, plan.filter("source = 'a'"), root, end, compute)
    total = store.resume(spark, plan, root, end, compute)
    assert computed == [["t1", "t2"], ["t3"]]          # finished parts are not computed again
    assert {(r["source"], r["dr_usd"]) for r in total.collect()} == {("a", 2.0), ("b", 3.0)}
    assert store.pending(spark, plan, root, date(2026, 8, 1)).count() == 3   # another window reuses nothing
    with pytest.raises(ValueError, match="stray"):
        store.load_parts(spark, plan.filter("source = 'a'"), root, end)
    more = plan.union(spark.createDataFrame([("b", "t9")], "source string, target string"))
    with pytest.raises(ValueError, match="missing"):
        store.load_parts(spark, more, root, end)
    # A target without rows is finished by its commit, and a rewritten part replaces only itself.
    empty = store.resume(spark, more, root, end, compute)
    assert store.pending(spark, more, root, end).isEmpty() and empty.count() == 2
    store.write_parts(results.filter("target = 't3'").withColumn("dr_usd", F.lit(9.0)), plan.filter("target = 't3'"), root, end)
    assert {(r["source"], r["dr_usd"]) for r in store.load_parts(spark, more, root, end, verify=True).collect()} == {("a", 2.0), ("b", 9.0)}


def test_changed_files_are_found(spark, tmp_path):
    root, end = tmp_path / "parts", date(2026, 7, 1)
    results, plan = _results(spark), _results(spark).select("source", "target")
    store.write_parts(results, plan, str(root), end)
    (folder,) = (root / "parts").glob("attempt=*")
    store.whole(results.filter("target = 't1'")).write.mode("append").parquet(str(folder))   # rows that no commit counted
    assert [r["target"] for r in store.changed_parts(spark, str(root), end).collect()] == ["t1"]
    with pytest.raises(ValueError, match="changed: a/t1"):
        store.load_parts(spark, plan, str(root), end, verify=True)


def test_rows_outside_the_plan_are_not_committed(spark, tmp_path):
    root, end = str(tmp_path / "parts"), date(2026, 7, 1)
    with pytest.raises(Exception, match="part not in the plan: b/t3"):
        store.write_parts(_results(spark), _results(spark).filter("source = 'a'").select("source", "target"), root, end)
    assert store.completed(spark, root, end).isEmpty()


def test_mixed_shards_stop_a_load(spark, tmp_path):
    root, end = str(tmp_path / "parts"), date(2026, 7, 1)
    results, plan = _results(spark).filter("source = 'b'"), _results(spark).filter("source = 'b'").select("source", "target")
    store.write_parts(results, plan, root, end)
    two = plan.selectExpr("*", "explode(array(0, 1)) as shard", "2 as shards")
    store.write_parts(results.selectExpr("*", "1 as shard", "2 as shards"), two, root, end)
    with pytest.raises(ValueError, match="mixed: b/t3"):
        store.load_parts(spark, two, root, end)


def test_settlement_resumes_by_target(spark, logs, tmp_path):
    root, end = str(tmp_path / "parts"), date(2025, 10, 2)
    some = se.plan_frame(spark, ["farms", "usds_aave"])
    first = se.settle_parts(logs, root, end, ["farms", "usds_aave"])
    assert {(r["source"], r["ref_code"]) for r in first.collect()} == {("farms", 12), ("usds_aave", 9001)}
    assert store.completed(spark, root, end).count() == some.count()
    whole = se.settle_parts(logs, root, end)
    want = {(r["source"], r["month"], r["token"], r["ref_code"]): r["dr_usd"] for r in se.settle(logs, end).collect()}
    got = {(r["source"], r["month"], r["token"], r["ref_code"]): r["dr_usd"] for r in whole.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)
    attempts = {r["attempt"] for r in store.completed(spark, root, end).collect()}
    assert se.settle_parts(logs, root, end).count() == whole.count()      # nothing is left to do
    assert {r["attempt"] for r in store.completed(spark, root, end).collect()} == attempts


def test_latest_run_is_greatest_stamp(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "x int")
    store.write_run(df, str(tmp_path), "r", "2026-07-03_185754")
    store.write_run(df.withColumn("x", F.lit(2)), str(tmp_path), "r", "2026-07-04_112934")
    assert store.read_latest_run(spark, str(tmp_path), "r").first()["x"] == "2"


def test_stage_cuts_lineage(spark, tmp_path):
    staged = store.stage(spark.range(10).selectExpr("id", "id * 2 as b"), str(tmp_path / "s"))
    assert "Range" not in staged._jdf.queryExecution().optimizedPlan().toString()
    assert staged.count() == 10
