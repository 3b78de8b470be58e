"""Reference series stored as CSV, read into long (code, month, value) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideledger.functions.dates import named_month
from tideledger.functions.labels import comma_number, plain_code

MONTH_ABBREVIATIONS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def _csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').csv(path)


def _melt(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    return df.unpivot([F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in values], "label", "text")


def read_long(spark: SparkSession, path: str, year: str, last_month: str, value: str = "tw_reward_usd") -> DataFrame:
    """Quoted long CSV summed by (code, month) within a year."""
    rows = _csv(spark, path).select(
        F.trim("ref_code").alias("code"), F.substring(F.trim("dt"), 1, 7).alias("month"),
        F.trim(value).try_cast("double").alias("value"))
    kept = rows.filter(F.col("month").startswith(year) & (F.col("month") <= last_month)
                       & (F.col("code") != "") & F.col("value").isNotNull())
    return kept.groupBy("code", "month").agg(F.sum("value").alias("value"))


def read_wide_named(
    spark: SparkSession, path: str, months: Sequence[str] | None = None, first_month: str | None = None,
    code_column: str = "Referral Code", keep_empty: bool = False,
) -> DataFrame:
    """Wide CSV with ``Mon YYYY`` columns and thousands separators.

    Months come from a list or start at ``first_month``. ``keep_empty`` keeps
    codes without any value as one row with null month.
    """
    raw = _csv(spark, path)
    named = [c for c in raw.columns if c.strip()[:3] in MONTH_ABBREVIATIONS and c.strip()[4:].strip().isdigit()]
    long = _melt(raw, [code_column], named).select(
        F.trim(F.col(f"`{code_column}`")).alias("code"), F.date_format(named_month(F.col("label")), "yyyy-MM").alias("month"),
        comma_number(F.col("text")).alias("value")).filter(F.col("code") != "")
    wanted = F.col("month").isin(*months) if months is not None else F.col("month") >= F.lit(first_month)
    values = long.filter(wanted & F.col("value").isNotNull() & (F.col("value") != 0))
    if not keep_empty:
        return values
    bare = long.select("code").distinct().join(values.select("code").distinct(), "code", "left_anti")
    return values.unionByName(bare, allowMissingColumns=True)


def read_triplets(spark: SparkSession, path: str, year: str) -> DataFrame:
    """CSV of repeated (token, code, reward) columns per month, summed by (code, month).

    Blank codes, text labels and zero rewards are left out.
    """
    raw = spark.read.option("header", False).option("escape", '"').csv(path)
    header = raw.limit(1).first()
    groups = []
    for i in range(0, len(header) - 2, 3):
        name = (header[i] or "").strip()
        if name in MONTH_ABBREVIATIONS:
            groups.append((f"{year}-{MONTH_ABBREVIATIONS.index(name) + 1:02d}", raw.columns[i + 1], raw.columns[i + 2]))
    cells = F.array(*[
        F.struct(F.lit(m).alias("month"), F.trim(F.col(code)).alias("code"), F.trim(F.col(dr)).alias("text"))
        for m, code, dr in groups
    ])
    rows = raw.select(F.inline(cells)).select("month", plain_code(F.col("code")).alias("code"),
                                              F.col("text").try_cast("double").alias("value"))
    kept = rows.filter(F.col("code").rlike(r"^-?\d") & F.col("value").isNotNull() & (F.col("value") != 0))
    return kept.groupBy("code", "month").agg(F.sum("value").alias("value"))


def read_rollup(spark: SparkSession, path: str, year: str, last_month: str) -> tuple[DataFrame, DataFrame]:
    """Own wide rollup (ref_code, token, months) to (series, tokens per code).

    Only tokens with a non-zero value in the year are listed.
    """
    raw = _csv(spark, path)
    months = [c for c in raw.columns if c[:4].isdigit() and c.startswith(f"{year}-") and c[:7] <= last_month]
    long = _melt(raw, ["ref_code", "token"], months).select(
        F.trim("ref_code").alias("code"), F.trim("token").alias("token"), F.substring("label", 1, 7).alias("month"),
        F.col("text").try_cast("double").alias("value")).filter(
        (F.col("code") != "") & F.col("value").isNotNull() & (F.col("value") != 0))
    series = long.groupBy("code", "month").agg(F.sum("value").alias("value"))
    tokens = long.select("code", "token").distinct().groupBy("code").agg(
        F.array_join(F.array_sort(F.collect_set("token")), ", ").alias("tokens"))
    return series, tokens


def thousands(value: Column, digits: int = 2) -> Column:
    """A number as text with thousands separators."""
    return F.format_number(value, digits)
