"""Rollups, report tables and comparisons of reward series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tideledger.functions.labels import (
    NON_PAYABLE_CODES, compound_label, leading_int, partner_group, with_notes,
)


def combine(
    parts: dict[str, DataFrame], slices: DataFrame | None = None, start: str | None = None, end: str | None = None,
    tolerate_after: str | None = None,
) -> DataFrame:
    """Monthly rewards of several sources in one frame with a ``source`` column.

    With ``slices`` (source, slice_start, slice_end: the windows the parts were computed for) a gap of any source in [start, end) fails the job.
    """
    named = [df.withColumn("source", F.lit(name)) for name, df in parts.items()]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
    if slices is None:
        return out
    from tideledger.operators.reconcile import covered

    return covered(out, slices, start, end, keys=["source"], overlaps=True, tolerate_after=tolerate_after)


def month_label(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


def _months(df: DataFrame, months: Sequence[str] | None) -> list[str]:
    """Column list of a pivot: given, or the distinct months (a bounded list)."""
    if months is not None:
        return list(months)
    rows = df.select(month_label(F.col("month")).alias("m")).distinct().orderBy("m").toLocalIterator()
    return [r["m"] for r in rows]


def wide_by_month(
    monthly: DataFrame, keys: Sequence[str], months: Sequence[str] | None = None,
    blank: str = "null", total: str = "total_dr_usd", digits: int | None = None,
) -> DataFrame:
    """One column per month plus a total.

    ``blank="null"`` leaves months without rows empty, ``"zero"`` fills them. With
    a month list the pivot needs no extra pass over the data.
    """
    columns = _months(monthly, months)
    value = F.sum("dr_usd") if digits is None else F.round(F.sum("dr_usd"), digits)
    wide = monthly.withColumn("m", month_label(F.col("month"))).groupBy(*keys).pivot("m", columns).agg(value)
    summed = reduce(lambda a, b: a + b, [F.coalesce(F.col(f"`{c}`"), F.lit(0.0)) for c in columns])
    wide = wide.withColumn(total, summed if digits is None else F.round(summed, digits))
    return wide.na.fill(0.0, columns) if blank == "zero" else wide


def rollup_by_code(monthly: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """Per code, codes 0 and 1 split by token."""
    labelled = monthly.withColumn("ref_code", compound_label(F.col("ref_code"), F.col("token")))
    return wide_by_month(labelled, ["ref_code"], months)


def rollup_by_code_token(monthly: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    return wide_by_month(monthly, ["ref_code", "token"], months)


def rollup_detail(monthly: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    return wide_by_month(monthly, ["ref_code", "token", "blockchain", "source"], months)


def tokens_by_code(monthly: DataFrame) -> DataFrame:
    """Sorted token list per code, only tokens with a non-zero month."""
    used = monthly.filter(F.col("dr_usd") != 0).select("ref_code", "token").distinct()
    return used.groupBy("ref_code").agg(F.array_join(F.array_sort(F.collect_set("token")), ", ").alias("tokens"))


def code_table(
    monthly: DataFrame, all_codes: DataFrame, notes: DataFrame, months: Sequence[str]
) -> DataFrame:
    """Report table: every known code, months (blank when absent), total, tokens, notes."""
    wide = wide_by_month(monthly, ["ref_code"], months, total="total", digits=2)
    keyed = all_codes.select("ref_code").distinct().join(wide, "ref_code", "left").join(
        tokens_by_code(monthly), "ref_code", "left"
    )
    filled = keyed.withColumn("total", F.coalesce("total", F.lit(0.0))).withColumn("tokens", F.coalesce("tokens", F.lit("")))
    return with_notes(filled, notes)


def group_summary(
    monthly: DataFrame, notes: DataFrame | None = None, labels: dict[str, str] | None = None
) -> DataFrame:
    """Per partner group: one row per code and a subtotal (code null).

    Codes without reward are left out.
    """
    per_code = monthly.groupBy("ref_code").agg(F.sum("dr_usd").alias("dr_usd")).filter(F.col("dr_usd") != 0)
    grouped = per_code.withColumn("partner_group", partner_group(F.col("ref_code"), labels))
    out = grouped.rollup("partner_group", "ref_code").agg(
        F.sum("dr_usd").alias("dr_usd"), F.grouping_id().alias("level")
    ).filter(F.col("level") < 3).withColumn("is_subtotal", F.col("level") == 1).drop("level")
    return out if notes is None else with_notes(out, notes)


def payable_view(
    monthly: DataFrame, eligibility: DataFrame, default_start: str, months: Sequence[str]
) -> DataFrame:
    """Rewards inside each code's eligibility window.

    ``eligibility``: ref_code, eligible_from, eligible_until (``yyyy-MM``, until
    exclusive, null = open). Codes without a beneficiary are listed with
    ``payable`` false and their all-time sum.
    """
    m = month_label(F.col("month"))
    windows = eligibility.select("ref_code", F.col("eligible_from").alias("_from"), F.col("eligible_until").alias("_until"))
    rows = monthly.withColumn("m", m).join(windows, "ref_code", "left")
    start = F.coalesce("_from", F.lit(default_start))
    inside = (F.col("m") >= start) & (F.col("_until").isNull() | (F.col("m") < F.col("_until")))
    payable = ~F.col("ref_code").isin(*NON_PAYABLE_CODES)
    counted = inside | ~payable
    usd = F.col("dr_usd")
    out = rows.groupBy("ref_code").agg(
        F.max(payable).alias("payable"),
        F.max(F.when(payable, start)).alias("eligible_from"),
        F.max(F.when(payable, F.col("_until"))).alias("eligible_until"),
        *[F.round(F.sum(F.when(counted & (F.col("m") == c), usd)), 2).alias(c) for c in months],
        F.round(F.sum(F.when(payable & inside, usd).otherwise(F.lit(0.0))), 2).alias("payable_total"),
        F.round(F.sum(F.when(payable & (F.col("m") < start), usd).when(payable, F.lit(0.0)).otherwise(usd)), 2)
        .alias("excluded_total"),
    )
    return out.filter(~F.col("payable") | (F.col("payable_total") != 0) | (F.col("excluded_total") != 0))


def rates_table(tokens: DataFrame, rates: DataFrame) -> DataFrame:
    """Rate class and rate of every token in use; unknown tokens are flagged.

    ``rates``: token, rate_type, apy, reward_per.
    """
    return tokens.select("token").distinct().join(rates, "token", "left").withColumn(
        "rate_type", F.coalesce("rate_type", F.lit("unknown"))
    )


# --- comparisons --------------------------------------------------------------

def merge_untagged(series: DataFrame, codes: Sequence[str], label: str = "untagged") -> DataFrame:
    """Put several untagged codes under one label (series: code, month, value)."""
    renamed = series.withColumn("code", F.when(F.col("code").isin(*codes), F.lit(label)).otherwise(F.col("code")))
    return renamed.groupBy("code", "month").agg(F.sum("value").alias("value"))


def common_months(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("month").distinct().join(b.select("month").distinct(), "month", "left_semi")


def series_diff(a: DataFrame, b: DataFrame, label_a: str, label_b: str, digits: int = 2) -> DataFrame:
    """Difference of two series (code, month, value) over their common months.

    Codes of either side appear; a missing side counts as 0 and ``present_in``
    says who has the code.
    """
    months = common_months(a, b)
    sides = (
        a.select("code", "month", F.col("value").alias("va"), F.lit(None).cast("double").alias("vb"))
        .unionByName(b.select("code", "month", F.lit(None).cast("double").alias("va"), F.col("value").alias("vb")))
    )
    presence = sides.groupBy("code").agg(
        F.max(F.col("va").isNotNull()).alias("in_a"), F.max(F.col("vb").isNotNull()).alias("in_b")
    )
    diffs = sides.join(months, "month", "left_semi").groupBy("code", "month").agg(
        F.round(F.coalesce(F.sum("va"), F.lit(0.0)) - F.coalesce(F.sum("vb"), F.lit(0.0)), digits).alias("diff")
    )
    where = F.when(F.col("in_a") & F.col("in_b"), F.lit("both")).when(
        F.col("in_a"), F.lit(f"{label_a} only")).otherwise(F.lit(f"{label_b} only"))
    return presence.join(diffs, "code", "left").select("code", where.alias("present_in"), "month", "diff")


def diff_totals(diff: DataFrame, digits: int = 2) -> DataFrame:
    return diff.groupBy("code", "present_in").agg(F.round(F.coalesce(F.sum("diff"), F.lit(0.0)), digits).alias("total_diff"))


def by_code_order(df: DataFrame, code: str = "code") -> DataFrame:
    """Numeric codes first in ascending order, then labels."""
    return df.orderBy(leading_int(F.col(code)).asc_nulls_last(), F.col(code).asc())
