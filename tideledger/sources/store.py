"""Result tables: stamped runs, resumable partial results, strict loads.

All paths are given by the caller and must be reachable by every executor.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

PART_KEYS = ["source", "target", "shard", "shards"]
LOG_COLUMNS = "window_end string, source string, target string, shard int, shards int, attempt string, part_rows bigint, digest decimal(38,0), committed bigint"


def run_stamp(now: datetime | None = None) -> str:
    """Stamp that sorts by time: ``YYYY-MM-DD_HHMMSS``."""
    return (now or datetime.now()).strftime("%Y-%m-%d_%H%M%S")


def write_run(df: DataFrame, root: str, name: str, stamp: str, fmt: str = "csv") -> str:
    """Write a result into the run's own folder; earlier runs stay."""
    path = f"{root}/{name}/run_ts={stamp}"
    df.write.mode("errorifexists").option("header", True).format(fmt).save(path)
    return path


def read_latest_run(spark: SparkSession, root: str, name: str, fmt: str = "csv") -> DataFrame:
    """The newest run by stamp, found by listing folders; only its folder is read."""
    stamps = [f.removeprefix("run_ts=") for f in _listed(spark, f"{root}/{name}") if f.startswith("run_ts=")]
    if not stamps:
        raise ValueError(f"no run under {root}/{name}")
    newest = max(stamps)
    table = spark.read.option("header", True).format(fmt).load(f"{root}/{name}/run_ts={newest}")
    return table.withColumn("run_ts", F.lit(newest))


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def _listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, through the file system's own interface; none if it does not exist."""
    p, fs = _path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(p)] if fs.exists(p) else []


# --- parts with a completion log ------------------------------------------------
#
# <root>/parts/attempt=<id>/...   results of one attempt; nobody trusts them by being there
# <root>/log/                     one small file a commit, published by one rename after the parts: which parts are
#                                 finished, in which attempt, with how many rows and what digest
#
# A killed attempt leaves files without log rows, and a target without results is a log row without files.

def whole(plan: DataFrame) -> DataFrame:
    """Plan rows with a shard; a plan without shards is made of whole targets."""
    if "shards" in plan.columns:
        return plan
    return plan.withColumns({"shard": F.lit(0), "shards": F.lit(1)})


def completed(spark: SparkSession, root: str, end: date) -> DataFrame:
    """The newest commit of each part of one window."""
    if not _exists(spark, f"{root}/log"):
        return spark.createDataFrame([], LOG_COLUMNS)
    log = spark.read.schema(LOG_COLUMNS).parquet(f"{root}/log").filter(F.col("window_end") == end.isoformat())
    newest = log.groupBy(*PART_KEYS).agg(F.max("committed").alias("committed"))
    return log.join(newest, [*PART_KEYS, "committed"], "left_semi")


def pending(spark: SparkSession, plan: DataFrame, root: str, end: date) -> DataFrame:
    """Plan rows without a finished result for this window end."""
    return whole(plan).join(completed(spark, root, end).select(*PART_KEYS), PART_KEYS, "left_anti")


def _measured(parts: DataFrame) -> DataFrame:
    """Rows and an order-free digest of each part."""
    values = sorted(c for c in parts.columns if c not in (*PART_KEYS, "attempt"))
    digest = F.sum(F.xxhash64(*values).cast("decimal(20,0)")).cast("decimal(38,0)")
    return parts.groupBy(*PART_KEYS).agg(F.count("*").alias("part_rows"), digest.alias("digest"))


def _attempt(spark: SparkSession, root: str, attempts: list[str]) -> DataFrame:
    return spark.read.option("basePath", f"{root}/parts").parquet(*[f"{root}/parts/attempt={a}" for a in attempts])


def write_parts(df: DataFrame, plan: DataFrame, root: str, end: date) -> None:
    """Store the results of ``plan``'s parts, then commit all of them at once.

    Every part of the plan is committed, those without rows too. Rows of a part that the plan does not
    name fail the commit. The digest is taken from the files that were written. Rows are rebalanced by part, so
    small parts share files and a large one is split over tasks. Rewriting a part supersedes its earlier commit.
    """
    spark, attempt, wanted = df.sparkSession, uuid.uuid4().hex, whole(plan).select(*PART_KEYS).distinct()
    path = f"{root}/parts/attempt={attempt}"
    rows = whole(df)
    rows.hint("rebalance", *PART_KEYS).write.mode("errorifexists").parquet(path)
    made = _measured(spark.read.schema(rows.schema).parquet(path)).withColumn("made", F.lit(True))
    log = wanted.withColumn("wanted", F.lit(True)).join(made, PART_KEYS, "full")
    named = F.concat_ws("/", "source", "target", "shard", "shards")
    stray = F.when(F.col("wanted").isNull(), F.raise_error(F.concat(F.lit("part not in the plan: "), named)).cast("string")).otherwise(F.lit(attempt))
    log.select(
        F.lit(end.isoformat()).alias("window_end"), *[F.col(k).cast("int") if k.startswith("shard") else F.col(k) for k in PART_KEYS], stray.alias("attempt"),
        F.coalesce("part_rows", F.lit(0)).cast("bigint").alias("part_rows"), F.coalesce("digest", F.lit(0)).cast("decimal(38,0)").alias("digest"),
        F.lit(time.time_ns()).alias("committed"),
    ).coalesce(1).write.mode("append").parquet(f"{root}/log")  # one row a part: a file of bounded size


def resume(spark: SparkSession, plan: DataFrame, root: str, end: date, compute: Callable[[DataFrame], DataFrame], verify: bool = False) -> DataFrame:
    """Compute the pending plan rows in one job, store them and return the plan's results."""
    todo = pending(spark, plan, root, end)
    if not todo.isEmpty():
        write_parts(compute(todo), todo, root, end)
    return load_parts(spark, plan, root, end, verify)


def plan_problems(spark: SparkSession, plan: DataFrame, root: str, end: date) -> DataFrame:
    """Differences between a plan and the completion log: source, target and problem.

    ``missing`` parts, ``stray`` ones that no plan row asked for, and targets stored under ``mixed`` shard counts, whose rows would count twice.
    """
    have = completed(spark, root, end).select(*PART_KEYS)
    want = whole(plan).select(*PART_KEYS).distinct()
    said = lambda df, problem: df.select("source", "target").distinct().withColumn("problem", F.lit(problem))
    out = said(want.join(have, PART_KEYS, "left_anti"), "missing").unionByName(said(have.join(want, PART_KEYS, "left_anti"), "stray"))
    return out.unionByName(said(mixed_shards(have), "mixed"))


def mixed_shards(parts: DataFrame) -> DataFrame:
    """Targets stored under more than one shard count."""
    return parts.groupBy("source", "target").agg(F.countDistinct("shards").alias("n")).filter(F.col("n") > 1)


def changed_parts(spark: SparkSession, root: str, end: date) -> DataFrame:
    """Finished parts whose files no longer have the committed rows or digest."""
    log = completed(spark, root, end)
    attempts = [r["attempt"] for r in log.filter("part_rows > 0").select("attempt").distinct().collect()]  # one an attempt
    if not attempts:
        return log.select("source", "target").limit(0)
    found = _measured(_attempt(spark, root, attempts).join(log.select(*PART_KEYS, "attempt"), [*PART_KEYS, "attempt"], "left_semi"))
    now = found.select(*PART_KEYS, F.col("part_rows").alias("rows_now"), F.col("digest").alias("digest_now"))
    return log.join(now, PART_KEYS, "left").filter(
        (F.coalesce("rows_now", F.lit(0)) != F.col("part_rows")) | (F.coalesce("digest_now", F.lit(0)) != F.col("digest"))).select("source", "target")


def windows(spark: SparkSession, root: str) -> list[str]:
    """Window ends with a commit, oldest first."""
    if not _exists(spark, f"{root}/log"):
        return []
    return sorted(r["window_end"] for r in spark.read.schema(LOG_COLUMNS).parquet(f"{root}/log").select("window_end").distinct().collect())


def load_parts(spark: SparkSession, plan: DataFrame, root: str, end: date, verify: bool = False) -> DataFrame:
    """Month sums of a strict load: any missing, stray or mixed part is an error.

    ``verify`` also reads all parts against their digests first.
    """
    parts = load_rows(spark, plan, root, end, verify)
    if parts is None:
        return spark.createDataFrame([], "month date, blockchain string, token string, ref_code bigint, source string, dr_usd double")
    return parts.groupBy("month", "blockchain", "token", "ref_code", "source").agg(F.sum("dr_usd").alias("dr_usd"))


def load_rows(spark: SparkSession, plan: DataFrame, root: str, end: date, verify: bool = False) -> DataFrame | None:
    """The stored rows of a plan, None if it has none; the same errors as :func:`load_parts`. Only files that the completion log names are read."""
    problems = plan_problems(spark, plan, root, end)
    if verify:
        problems = problems.unionByName(changed_parts(spark, root, end).withColumn("problem", F.lit("changed")))
    told = [f"{r['problem']}: {r['source']}/{r['target']}" for r in problems.collect()]  # one row a part at most
    if told:
        raise ValueError(f"stored parts do not match the plan: {told}")
    log = completed(spark, root, end)
    kept = log.filter("part_rows > 0").select(*PART_KEYS, "attempt").collect()  # one row a part
    if not kept:
        return None
    attempts = sorted({r["attempt"] for r in kept})
    rows = _attempt(spark, root, attempts)
    if len(attempts) > 1:  # an attempt may hold parts that a later one superseded
        rows = rows.join(log.select(*PART_KEYS, "attempt"), [*PART_KEYS, "attempt"], "left_semi")
    else:
        rows = rows.filter(F.concat_ws("/", *PART_KEYS).isin(*["/".join(str(r[k]) for k in PART_KEYS) for r in kept]))
    return rows.drop("attempt")


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate table once and read it back.

    Cuts the lineage with files every executor can read, so losing executors
    never repeats the work behind it.
    """
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
