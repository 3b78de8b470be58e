"""The shared scan: what is pushed to the reader, what is skipped, and what each rule lets through."""

from datetime import date

from helpers import DAY, ZERO, topic, word
from pyspark.sql import functions as F
from test_settlement import AAVE, L2, SUSDS, A, B, log, logs, transfer  # noqa: F401

from tideledger.functions import codec
from tideledger.plans import settlement as se
from tideledger.sources import logs as lo, scan as sc
from tideledger.sources.registry import SOURCES

UNTIL = sc.second_of(date(2026, 8, 1))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan()


def metric(df, name):
    df.collect()
    leaves = plan_of(df).collectLeaves()
    return sum(leaves.apply(i).metrics().apply(name).value() for i in range(leaves.size()))


def clustered(spark, tmp_path):
    noise = [transfer(t, i, DAY + i, A, B, 1, f"n{i}", address="0x" + f"{i:040x}") for t in (SUSDS, L2) for i in range(400)]
    usds = [transfer(AAVE, i, DAY + i, A, B, 1, f"u{i}") for i in range(300)]
    wanted = [transfer(AAVE, 900, DAY, A, AAVE.holder, 100, "h1"), transfer(AAVE, 901, DAY, AAVE.holder, A, 40, "h2"),
              transfer(AAVE, 902, DAY, AAVE.holder, AAVE.holder, 5, "h3"), transfer(AAVE, 903, DAY - 200 * 86400, A, AAVE.holder, 7, "early"),
              log("base", L2.swap_contract, 1, 2, DAY, codec.SWAP_TOPIC, [topic(B), topic(L2.address), topic(A)], [word(1), word(1), word(7)], "l1"),
              log("base", L2.swap_contract, 1, 3, DAY, codec.SWAP_TOPIC, [topic(B), topic(B), topic(A)], [word(1), word(1), word(8)], "l2")]
    path = str(tmp_path / "logs")
    sc.write_clustered(spark.createDataFrame(noise + usds + wanted, lo.LOG_SCHEMA), path, 24)
    return spark.read.parquet(path)


def test_holder_and_output_token_reach_the_reader(spark, tmp_path, capsys):
    stored = clustered(spark, tmp_path)
    rules = sc.source_rules(SOURCES["usds_aave"], UNTIL) + sc.source_rules(SOURCES["susds_psm3"], UNTIL)
    hit = stored.filter(sc.predicate(rules, stored.columns))
    hit.explain(mode="formatted")
    pushed = capsys.readouterr().out.split("PushedFilters")[1]
    for literal in (topic(AAVE.holder), topic(L2.address), L2.swap_contract, codec.SWAP_TOPIC):
        assert literal in pushed
    assert metric(hit, "numFiles") < metric(stored, "numFiles") / 3
    assert metric(hit, "numOutputRows") < metric(stored, "numOutputRows") / 2


def test_rules_tag_what_a_source_asks_for(spark, tmp_path):
    stored = clustered(spark, tmp_path)
    rules = sc.source_rules(SOURCES["usds_aave"], UNTIL) + sc.source_rules(SOURCES["susds_psm3"], UNTIL)
    got = {(r["role"], r["source"], r["tx_hash"]): (r["from_addr"], r["to_addr"], r["owner"], r["ref_code"]) for r in sc.tagged_events(stored, rules).collect()}
    assert got == {("move", "usds_aave", "h1"): (ZERO, AAVE.holder, None, 9001), ("move", "usds_aave", "h2"): (AAVE.holder, ZERO, None, 9001),
                   ("code", "susds_psm3", "l1"): (None, None, A, 7)}


def test_one_log_can_serve_two_sources(spark):
    both = SOURCES["usds_ref4001"].targets[0].holder
    moved = spark.createDataFrame([transfer(AAVE, 1, DAY, AAVE.holder, both, 3, "x")], lo.LOG_SCHEMA)
    specs = [SOURCES["usds_aave"], SOURCES["usds_ref4001"]]
    legs = se.tagged_legs(se.scanned(moved, se.rules_of(specs, date(2025, 2, 1))), specs)
    assert {(r["source"], r["user_addr"], r["amount_change"], r["ref_code"]) for r in legs.collect()} == {
        ("usds_aave", AAVE.holder, -3.0, 9001), ("usds_ref4001", both, 3.0, 4001)}


def test_settle_reads_the_log_once(spark, logs, tmp_path):  # noqa: F811
    path, stage = str(tmp_path / "raw"), str(tmp_path / "stage")
    logs.write.parquet(path)
    months = se.settle(spark.read.parquet(path), date(2025, 10, 2), stage=stage)
    plan = months._jdf.queryExecution().optimizedPlan().toString()
    assert "topic0" not in plan and "Project" in plan            # everything after the stored events reads those
    scans = [str(plan_of(months).toString())]
    assert scans[0].count("FileScan parquet") <= 8 and path not in scans[0]
    got = {(r["source"], r["token"], r["ref_code"]) for r in months.collect()}
    assert got == {("susds_susdc", "sUSDS", 777), ("susds_susdc", "sUSDS", 1003), ("susds_susdc", "sUSDS", 99), ("farms", "USDS-SKY", 12), ("psm3", "sUSDS", 10000),
                   ("sp", "spUSDC", 131), ("usds_aave", "USDS", 9001)}
    parts = spark.read.parquet(stage).groupBy("role").agg(F.count("*").alias("n")).collect()
    assert {r["role"]: r["n"] for r in parts} == {"move": 10, "code": 3, "flow": 1, "idle": 1}


def test_clustered_store_keeps_every_log(spark, logs, tmp_path):  # noqa: F811
    path = str(tmp_path / "c")
    sc.write_clustered(logs, path, 3)
    columns = lo.LOG_SCHEMA.names
    assert spark.read.parquet(path).select(*columns).exceptAll(logs.select(*columns)).isEmpty() and spark.read.parquet(path).count() == logs.count()
