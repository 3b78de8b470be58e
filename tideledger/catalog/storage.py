"""Captures, reference series and result tables, written and read back.

Every query writes the given data's results to a new folder under the shared
directory and reads them again.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Window, functions as F

from tideledger.catalog.base import EV, LEDGER_MONTHS, TR, Ctx, query, with_
from tideledger.catalog.events import _id
from tideledger.catalog.reporting import MONTHLY, monthly
from tideledger.operators import rollup as ru
from tideledger.session import shared_dir
from tideledger.sources import logs as lo, series as sr, store

YEAR = [m for m in LEDGER_MONTHS if m.startswith("2026")]
NAMES = sr.MONTH_ABBREVIATIONS


def folder(c: Ctx, name: str) -> str:
    return f"{shared_dir(c.spark)}/tideledger/{name}-{uuid.uuid4().hex}"


@query("s7_read_captures", with_(EV, TR) + f"SELECT tx_hash, log_index, {_id('to_addr')} AS to_addr, amount FROM tr")
def s7(c: Ctx):
    path = folder(c, "captures")
    row = F.struct(*[f.name for f in lo.LOG_SCHEMA.fields])
    # One JSON array per block and line.
    lines = c.logs.groupBy("blockchain", "block_number").agg(F.to_json(F.collect_list(row)).alias("value"))
    lines.select("value").write.option("compression", "gzip").text(path)
    moves = lo.transfers(lo.read_captures(c.spark, path, whole_file=False))
    return moves.select("tx_hash", "log_index", "to_addr", F.col("amount").cast("bigint").alias("amount"))


@query("s8_read_long_csv", with_(MONTHLY) + "SELECT CAST(ref_code AS VARCHAR) AS code, m AS month, sum(dr_usd) AS value FROM monthly WHERE m BETWEEN '2026-01' AND '2026-06' GROUP BY 1, 2")
def s8(c: Ctx):
    path = folder(c, "long")
    m = monthly(c).select(F.date_format("month", "yyyy-MM-dd 00:00:00.000").alias("dt"), "blockchain", "token", "ref_code", F.col("dr_usd").alias("tw_reward_usd"))
    m.write.option("header", True).option("quoteAll", True).csv(path)
    return sr.read_long(c.spark, path, "2026", "2026-06")


def _wide_named(c: Ctx, path: str) -> str:
    m = monthly(c).withColumn("label", F.date_format("month", "MMM yyyy"))
    labels = [f"{NAMES[int(x[5:7]) - 1]} {x[:4]}" for x in YEAR]
    wide = m.groupBy(F.col("ref_code").alias("Referral Code")).pivot("label", labels).agg(F.format_number(F.sum("dr_usd"), 7))
    wide.withColumn("Partner Name", F.lit("a, b")).write.option("header", True).csv(path)
    return path


@query("s9_read_wide_csv", with_(MONTHLY) + "SELECT CAST(ref_code AS VARCHAR) AS code, m AS month, sum(dr_usd) AS value FROM monthly WHERE m IN ('2026-01', '2026-02', '2026-03') GROUP BY 1, 2")
def s9(c: Ctx):
    return sr.read_wide_named(c.spark, _wide_named(c, folder(c, "wide")), months=["2026-01", "2026-02", "2026-03"])


@query("s9_read_payouts_csv", with_(MONTHLY) + "SELECT CAST(ref_code AS VARCHAR) AS code, m AS month, sum(dr_usd) AS value FROM monthly WHERE m BETWEEN '2026-03' AND '2026-12' GROUP BY 1, 2")
def s9b(c: Ctx):
    return sr.read_wide_named(c.spark, _wide_named(c, folder(c, "payouts")), first_month="2026-03")


@query("s10_read_triplets", with_(MONTHLY) + """
SELECT CAST(ref_code AS VARCHAR) AS code, m AS month, sum(dr_usd) AS value FROM monthly WHERE m LIKE '2026-%' AND ref_code <> 1003 GROUP BY 1, 2""")
def s10(c: Ctx):
    path = folder(c, "triplets")
    m = monthly(c).groupBy(ru.month_label(F.col("month")).alias("m"), "token", "ref_code").agg(F.sum("dr_usd").alias("dr")).filter(F.col("m").startswith("2026-"))
    text = F.when(F.col("ref_code") == 1003, F.lit("Treasury")).when(F.col("ref_code") == 127, F.lit("1.27E+2")).otherwise(F.col("ref_code").cast("string"))
    ranked = m.withColumn("code", text).withColumn("rn", F.row_number().over(Window.partitionBy("m").orderBy("token", "ref_code")))
    cells, header = [], []
    for i, x in enumerate(YEAR):
        here = F.col("m") == x
        cells += [F.max(F.when(here, F.col("token"))).alias(f"t{i}"), F.max(F.when(here, F.col("code"))).alias(f"c{i}"),
                  F.max(F.when(here, F.col("dr").cast("string"))).alias(f"d{i}")]
        header += [NAMES[i], "code", "dr"]
    rows = ranked.groupBy("rn").agg(*cells)
    head = c.spark.createDataFrame([tuple([0] + header)], rows.schema)
    # A report of a few dozen lines: one file, header first.
    head.unionByName(rows).coalesce(1).sortWithinPartitions("rn").drop("rn").write.csv(path)
    return sr.read_triplets(c.spark, path, "2026")


@query("s11_read_rollup_series", with_(MONTHLY) + "SELECT CAST(ref_code AS VARCHAR) AS code, m AS month, sum(dr_usd) AS value FROM monthly WHERE m BETWEEN '2026-01' AND '2026-07' GROUP BY 1, 2")
def s11(c: Ctx):
    path = folder(c, "rollup")
    ru.rollup_by_code_token(monthly(c), LEDGER_MONTHS).write.option("header", True).csv(path)
    return sr.read_rollup(c.spark, path, "2026", "2026-07")[0]


@query("s11_read_rollup_tokens", with_(MONTHLY) + """
SELECT CAST(ref_code AS VARCHAR) AS code, string_agg(DISTINCT token, ', ' ORDER BY token) AS tokens FROM monthly WHERE m BETWEEN '2026-01' AND '2026-07' AND dr_usd <> 0 GROUP BY 1""")
def s11b(c: Ctx):
    path = folder(c, "rollup")
    ru.rollup_by_code_token(monthly(c), LEDGER_MONTHS).write.option("header", True).csv(path)
    return sr.read_rollup(c.spark, path, "2026", "2026-07")[1]


@query("s12_latest_run", with_(MONTHLY) + "SELECT token, m AS month, sum(dr_usd) AS dr_usd FROM monthly GROUP BY 1, 2")
def s12(c: Ctx):
    root = folder(c, "runs")
    m = monthly(c).groupBy("token", ru.month_label(F.col("month")).alias("month")).agg(F.sum("dr_usd").alias("dr_usd"))
    store.write_run(m.filter("token = 'sUSDS'"), root, "monthly", "2026-07-03_185754")
    store.write_run(m, root, "monthly", "2026-07-04_112934")
    latest = store.read_latest_run(c.spark, root, "monthly")
    return latest.select("token", "month", F.col("dr_usd").cast("double").alias("dr_usd"))


def _targets(df):
    return df.withColumn("target", F.concat_ws("_", "blockchain", "token"))


PARTS = "SELECT month, blockchain, token, ref_code, source, sum(dr_usd) AS dr_usd FROM monthly GROUP BY ALL"


@query("s13_resume_parts", with_(MONTHLY) + PARTS)
def s13(c: Ctx):
    root, end = folder(c, "parts"), date(2030, 9, 1)
    results = _targets(monthly(c))
    plan = results.select("source", "target").distinct()
    # The first attempt finishes one family only; the second computes the rest.
    store.resume(c.spark, plan.filter("source = 'sp'"), root, end, lambda todo: results.join(todo.select("source", "target"), ["source", "target"], "left_semi"))
    return store.resume(c.spark, plan, root, end, lambda todo: results.join(todo.select("source", "target"), ["source", "target"], "left_semi"))


@query("s13_pending_parts", with_(MONTHLY) + "SELECT DISTINCT source, blockchain || '_' || token AS target FROM monthly WHERE source = 'other'")
def s13_pending(c: Ctx):
    root, end = folder(c, "parts"), date(2030, 9, 1)
    results = _targets(monthly(c))
    plan = results.select("source", "target").distinct()
    store.write_parts(results.filter("source = 'sp'"), plan.filter("source = 'sp'"), root, end)
    store.write_parts(results, plan, root, date(2030, 8, 1))  # another window: not reusable
    return store.pending(c.spark, plan, root, end).select("source", "target")


@query("s13_empty_target", with_(MONTHLY) + PARTS)
def s13_empty(c: Ctx):
    # Every token also has a target without any result: finished once, never computed again, never missing.
    root, end = folder(c, "parts"), date(2030, 9, 1)
    results = _targets(monthly(c))
    plan = results.select("source", "target").union(results.select("source", F.concat(F.lit("none_"), F.col("token")))).distinct()
    compute = lambda todo: results.join(todo.select("source", "target"), ["source", "target"], "left_semi")
    store.resume(c.spark, plan, root, end, compute)
    if not store.pending(c.spark, plan, root, end).isEmpty():
        raise ValueError("a finished target is pending")
    return store.load_parts(c.spark, plan, root, end, verify=True)


@query("s13_killed_attempt", with_(MONTHLY) + PARTS)
def s13_killed(c: Ctx):
    # An attempt that died wrote half of its files and no commit: its rows count nowhere.
    root, end = folder(c, "parts"), date(2030, 9, 1)
    results = _targets(monthly(c))
    plan = results.select("source", "target").distinct()
    store.whole(results.filter("ref_code <= 2")).write.parquet(f"{root}/parts/attempt=killed")
    return store.resume(c.spark, plan, root, end, lambda todo: results.join(todo.select("source", "target"), ["source", "target"], "left_semi"))


@query("s14_strict_load", with_(MONTHLY) + PARTS)
def s14(c: Ctx):
    root, end = folder(c, "parts"), date(2030, 9, 1)
    results = _targets(monthly(c))
    plan = results.select("source", "target").distinct()
    store.write_parts(results, plan, root, end)
    return store.load_parts(c.spark, plan, root, end)


@query("s14_plan_problems", with_(MONTHLY) + """
SELECT DISTINCT source, blockchain || '_' || token AS target, 'stray' AS problem FROM monthly WHERE token = 'spETH'
UNION ALL SELECT DISTINCT source, 'later_' || token, 'missing' FROM monthly""")
def s14_problems(c: Ctx):
    root, end = folder(c, "parts"), date(2030, 9, 1)
    results = _targets(monthly(c))
    store.write_parts(results, results.select("source", "target").distinct(), root, end)
    plan = results.filter("token <> 'spETH'").select("source", "target").union(
        results.select("source", F.concat(F.lit("later_"), F.col("token")))).distinct()
    return store.plan_problems(c.spark, plan, root, end)


def _sharded(df, shards: int):
    """Rows dealt into shards by code; a plan of all shards goes with them."""
    return df.withColumns({"shard": (F.abs("ref_code") % shards).cast("int"), "shards": F.lit(shards)})


@query("s14_sharded_load", with_(MONTHLY) + PARTS)
def s14_sharded(c: Ctx):
    root, end = folder(c, "parts"), date(2030, 9, 1)
    results = _targets(monthly(c))
    targets = results.select("source", "target").distinct()
    plan = targets.withColumn("shard", F.explode(F.array(*map(F.lit, range(4))))).withColumn("shards", F.lit(4))
    store.write_parts(_sharded(results, 4), plan, root, end)  # shards without rows are finished too
    return store.load_parts(c.spark, plan, root, end, verify=True)


@query("s14_mixed_shards", with_(MONTHLY) + """
SELECT DISTINCT source, blockchain || '_' || token AS target, p AS problem FROM monthly, (VALUES ('mixed'), ('stray')) AS t(p) WHERE source = 'sp'""")
def s14_mixed(c: Ctx):
    # The vaults are stored whole and in two shards: both are commits of one target, and their rows would count twice.
    root, end = folder(c, "parts"), date(2030, 9, 1)
    results = _targets(monthly(c))
    targets = results.select("source", "target").distinct()
    store.write_parts(results, targets, root, end)
    vaults = targets.filter("source = 'sp'").withColumn("shard", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("shards", F.lit(2))
    store.write_parts(_sharded(results.filter("source = 'sp'"), 2), vaults, root, end)
    return store.plan_problems(c.spark, targets, root, end)
