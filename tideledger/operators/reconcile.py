"""Parity, quality and payment checks as data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tideledger.functions.dates import month_start
from tideledger.operators.rollup import month_label

TWA_KEYS = ["blockchain", "contract_address", "user_addr", "dt", "ref_code"]


def outer_diff(ours: DataFrame, theirs: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Both sides of every key: ``<m>_ours``, ``<m>_theirs`` and ``present_in``."""
    a = ours.select(*keys, *[F.col(m).alias(f"{m}_ours") for m in measures], F.lit(True).alias("_a"))
    b = theirs.select(*keys, *[F.col(m).alias(f"{m}_theirs") for m in measures], F.lit(True).alias("_b"))
    side = F.when(F.col("_a") & F.col("_b"), F.lit("both")).when(F.col("_a"), F.lit("ours")).otherwise(F.lit("theirs"))
    return a.join(b, list(keys), "full_outer").withColumn("present_in", side).drop("_a", "_b")


def month_diff(ours: DataFrame, theirs: DataFrame, month: str, keys: Sequence[str], measure: str = "amount",
               floor: float = 1.0) -> DataFrame:
    """Differences above the floor within one month, with percentages."""
    d = outer_diff(ours, theirs, keys, [measure])
    o, t = F.col(f"{measure}_ours"), F.col(f"{measure}_theirs")
    delta = F.coalesce(o, F.lit(0.0)) - F.coalesce(t, F.lit(0.0))
    pct = F.when(t.isNull() | (t == 0), F.lit(None).cast("double")).otherwise(
        (F.coalesce(o, F.lit(0.0)) - t) / t * F.lit(100.0))
    inside = month_start(F.col("dt")) == F.to_date(F.lit(f"{month}-01"))
    return d.filter(inside).withColumns({"delta": delta, "delta_pct": pct}).filter(F.abs("delta") > floor).drop("present_in")


def twa_parity(ours: DataFrame, theirs: DataFrame, tol: float = 1e-6) -> DataFrame:
    """One row of parity metrics for two daily balance tables."""
    bal, kind, dur = "time_weighted_avg_balance", "day_type", "segment_duration_seconds"
    d = outer_diff(ours, theirs, TWA_KEYS, [bal, kind, dur])
    both = F.col("present_in") == "both"
    a, b = F.col(f"{bal}_ours"), F.col(f"{bal}_theirs")
    gap = F.abs(a - b)
    tx = both & (F.col(f"{kind}_theirs") == "transaction_day")
    count_if = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    m = d.agg(
        count_if(both).alias("matched"),
        count_if(F.col("present_in") == "ours").alias("only_ours"),
        count_if(F.col("present_in") == "theirs").alias("only_theirs"),
        count_if(both & (gap <= tol)).alias("within_tol"),
        count_if(both & (F.col(f"{kind}_ours") != F.col(f"{kind}_theirs"))).alias("day_type_mismatches"),
        count_if(tx).alias("tx_rows"),
        count_if(tx & (F.abs(F.col(f"{dur}_ours") - F.col(f"{dur}_theirs")) <= 0.5)).alias("duration_exact"),
        F.max(F.when(both, gap)).alias("max_abs_diff"),
        F.sum(a).alias("_sum_a"), F.sum(b).alias("_sum_b"),
        F.max(F.when(~both, F.abs(F.coalesce(a, b)))).alias("max_unmatched"),
    )
    rel = F.abs(F.col("_sum_a") - F.col("_sum_b")) / F.greatest(F.abs(F.col("_sum_b")), F.lit(1e-18))
    return m.withColumn("sum_reldiff", rel).drop("_sum_a", "_sum_b")


def series_parity(ours: DataFrame, theirs: DataFrame, keys: Sequence[str], measure: str,
                  by: Sequence[str] = ()) -> DataFrame:
    """Matched, unmatched and largest differences of any keyed measure."""
    d = outer_diff(ours, theirs, keys, [measure])
    both = F.col("present_in") == "both"
    gap = F.abs(F.col(f"{measure}_ours") - F.col(f"{measure}_theirs"))
    rel = gap / F.greatest(F.abs(F.col(f"{measure}_theirs")), F.lit(1e-18))
    return d.groupBy(*by).agg(
        F.sum(both.cast("bigint")).alias("matched"),
        F.sum((F.col("present_in") == "ours").cast("bigint")).alias("only_ours"),
        F.sum((F.col("present_in") == "theirs").cast("bigint")).alias("only_theirs"),
        F.max(F.when(both, gap)).alias("max_abs_diff"), F.max(F.when(both, rel)).alias("max_rel_diff"),
    )


def program_impact(with_program: DataFrame, baseline: DataFrame) -> DataFrame:
    """Monthly reward per code with and without a program.

    Tagging only moves balance between codes, so a month's deltas add up to
    (about) zero; ``month_net`` shows it next to each row.
    """
    a = with_program.groupBy("month", "ref_code").agg(F.sum("dr_usd").alias("dr"))
    b = baseline.groupBy("month", "ref_code").agg(F.sum("dr_usd").alias("dr"))
    d = outer_diff(a, b, ["month", "ref_code"], ["dr"]).select(
        "month", "ref_code", F.coalesce("dr_ours", F.lit(0.0)).alias("with_program"),
        F.coalesce("dr_theirs", F.lit(0.0)).alias("baseline"),
    ).withColumn("delta", F.col("with_program") - F.col("baseline"))
    net = d.groupBy("month").agg(F.sum("delta").alias("month_net"))
    return d.join(net, "month")


# --- quality checks -----------------------------------------------------------

def _check(name: str, result: Column, detail: Column, df: DataFrame) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), result.alias("result"), detail.alias("detail"))


def venue_set_diff(new: DataFrame, old: DataFrame, skip_codes: Sequence[int]) -> DataFrame:
    """Venues (code, token) only one side has."""
    pairs = lambda df: df.filter(~F.col("ref_code").isin(*skip_codes)).select("ref_code", "token").distinct()
    a, b = pairs(new), pairs(old)
    return a.exceptAll(b).withColumn("only_in", F.lit("new")).unionByName(
        b.exceptAll(a).withColumn("only_in", F.lit("old")))


def month_moves(new: DataFrame, old: DataFrame, skip_codes: Sequence[int], expected: DataFrame,
                min_value: float = 10.0, min_usd: float = 25.0, min_share: float = 0.02) -> DataFrame:
    """Cells of the old table that moved by more than the bigger of an absolute
    and a relative bound, classed by ``expected`` (ref_code, reason)."""
    keys = ["ref_code", "token", "month"]
    cells = old.filter(~F.col("ref_code").isin(*skip_codes) & (F.abs("dr_usd") >= min_value))
    joined = cells.select(*keys, F.col("dr_usd").alias("old_usd")).join(
        new.select(*keys, F.col("dr_usd").alias("_new")), keys, "left"
    ).withColumn("new_usd", F.coalesce("_new", F.lit(0.0))).drop("_new")
    bound = F.greatest(F.lit(min_usd), F.lit(min_share) * F.abs("old_usd"))
    moved = joined.filter(F.abs(F.col("new_usd") - F.col("old_usd")) > bound)
    return moved.join(expected, "ref_code", "left").withColumn(
        "classification", F.coalesce("reason", F.lit("UNEXPECTED"))).drop("reason")


def quality_checks(
    new: DataFrame, old: DataFrame, measured: DataFrame, aggregator_codes: Sequence[int],
    slack: DataFrame, expected: DataFrame,
) -> DataFrame:
    """Venue set, aggregator totals, uncovered months and moves in one frame.

    ``new``/``old``: ref_code, token, month (yyyy-MM), dr_usd. ``measured``:
    ref_code, month, delta. ``slack``: ref_code, slack_usd.
    """
    venues = venue_set_diff(new, old, aggregator_codes).agg(
        F.sum((F.col("only_in") == "new").cast("bigint")).alias("n"), F.sum((F.col("only_in") == "old").cast("bigint")).alias("o"))
    n, o = F.coalesce("n", F.lit(0)), F.coalesce("o", F.lit(0))
    out = _check("venue set", F.when(n + o == 0, F.lit("OK")).otherwise(F.lit("DIFFERS")),
                 F.concat(F.lit("only new="), n.cast("string"), F.lit(" only old="), o.cast("string")), venues)

    dated = new.withColumn("last_month", measured.agg(F.max("month")).scalar())
    covered = F.col("month") <= F.col("last_month")
    got = dated.filter(covered & F.col("ref_code").isin(*aggregator_codes)).groupBy("ref_code").agg(F.sum("dr_usd").alias("got"))
    want = measured.filter(F.col("ref_code").isin(*aggregator_codes)).groupBy("ref_code").agg(F.sum("delta").alias("want"))
    totals = slack.join(want, "ref_code", "left").join(got, "ref_code", "left").select(
        "ref_code", "slack_usd", F.coalesce("want", F.lit(0.0)).alias("want"), F.coalesce("got", F.lit(0.0)).alias("got"))
    ok = F.col("got").between(F.col("want") - 1.0, F.col("want") + F.col("slack_usd"))
    out = out.unionByName(totals.select(
        F.concat(F.lit("aggregator total "), F.col("ref_code")).alias("check_name"),
        F.when(ok, F.lit("OK")).otherwise(F.lit("MISMATCH")).alias("result"),
        F.concat(F.lit("got="), F.round("got", 2).cast("string"), F.lit(" measured="), F.round("want", 2).cast("string")).alias("detail"),
    ))
    beyond = dated.filter(~covered).select("month").distinct()
    out = out.unionByName(beyond.select(
        F.concat(F.lit("month beyond measurement "), F.col("month")).alias("check_name"),
        F.lit("UNVERIFIED").alias("result"), F.lit("no independent measurement").alias("detail"),
    ))
    moves = month_moves(new, old, aggregator_codes, expected).agg(
        F.count("*").alias("m"), F.coalesce(F.sum((F.col("classification") == "UNEXPECTED").cast("bigint")), F.lit(0)).alias("u"))
    return out.unionByName(_check(
        "month moves", F.when(F.col("u") == 0, F.lit("OK")).otherwise(F.lit("UNEXPECTED")),
        F.concat(F.lit("moved="), F.col("m").cast("string"), F.lit(" unexpected="), F.col("u").cast("string")), moves))


def rate_basis_check(rates: DataFrame, expected: DataFrame, tol: float = 1e-15) -> DataFrame:
    """Compare the schedule in use with expected (reward_code, dt, reward_per)."""
    tiers = rates.select(F.col("reward_code").alias("_code"), "start_dt", "end_dt", F.col("reward_per").alias("actual"))
    match = (F.col("_code") == F.col("reward_code")) & F.col("dt").between(F.col("start_dt"), F.col("end_dt"))
    wanted = expected.select("reward_code", "dt", F.col("reward_per").alias("expected"))
    joined = wanted.join(tiers, match, "left").select("reward_code", "dt", "expected", "actual")
    good = F.abs(F.col("actual") - F.col("expected")) <= tol
    return joined.withColumn("result", F.when(good, F.lit("OK")).otherwise(F.lit("MISMATCH")))


# --- payments -----------------------------------------------------------------

def reconcile_payments(
    monthly: DataFrame, paid: DataFrame, codes: DataFrame, months: Sequence[str], uncovered: str = "fail",
) -> DataFrame:
    """Calculated against paid for every listed code and month.

    ``codes``: ref_code, partner; ``months``: ``yyyy-MM`` labels; ``paid``: ref_code,
    month, paid_usd (null = no payment line). A listed month after the last, or before the first, calculated one is not covered: it fails the
    job, or with ``uncovered="null"`` has no calculated amount and no difference. A covered month without rows of a code is 0.
    """
    if uncovered not in ("fail", "null"):
        raise ValueError("uncovered is 'fail' or 'null'")
    label = month_label(F.col("month"))
    span = monthly.select(F.min(label).alias("a"), F.max(label).alias("b"))
    grid = codes.select("ref_code", "partner", F.explode(F.array(*[F.lit(m) for m in months])).alias("month"))
    grid = grid.withColumns({"first_month": span.select("a").scalar(), "last_month": span.select("b").scalar()})
    inside = F.coalesce(F.col("month").between(F.col("first_month"), F.col("last_month")), F.lit(False))
    if uncovered == "fail":
        told = F.concat(F.lit("month not covered by the calculated rewards: "), F.col("month"))
        inside = F.when(inside, F.lit(True)).otherwise(F.raise_error(told).cast("boolean"))
    calc = monthly.groupBy("ref_code", label.alias("month")).agg(F.sum("dr_usd").alias("calc"))
    joined = grid.withColumn("covered", inside).join(calc, ["ref_code", "month"], "left").join(paid, ["ref_code", "month"], "left")
    rounded = F.when(F.col("covered"), F.round(F.coalesce("calc", F.lit(0.0)), 2))
    return joined.select(
        "month", "ref_code", "partner", rounded.alias("calculated_dr_usd"), F.col("paid_usd").alias("paid_dr_usd"),
        F.round(F.col("paid_usd") - rounded, 2).alias("diff_paid_minus_calc"),
    )


def payment_summary(lines: DataFrame) -> DataFrame:
    """Per code: calculated and paid over the paid window, and months after it.

    Codes without any payment line are memo rows with null payments.
    """
    with_payment = lines.filter(F.col("paid_dr_usd").isNotNull())
    dated = lines.withColumns({
        "first_paid": with_payment.agg(F.min("month")).scalar(), "last_paid": with_payment.agg(F.max("month")).scalar(),
    })
    inside = F.col("month").between(F.col("first_paid"), F.col("last_paid"))
    calc = F.col("calculated_dr_usd")
    out = dated.groupBy("ref_code", "partner").agg(
        F.round(F.sum(F.when(F.col("month") < F.col("first_paid"), calc).otherwise(F.lit(0.0))), 2).alias("calc_before"),
        F.round(F.sum(F.when(inside, calc).otherwise(F.lit(0.0))), 2).alias("calc_window"),
        F.round(F.sum("paid_dr_usd"), 2).alias("paid_window"),
        F.round(F.sum(F.when(F.col("month") > F.col("last_paid"), calc).otherwise(F.lit(0.0))), 2).alias("calc_unpaid"),
    )
    return out.withColumn("diff", F.round(F.col("paid_window") - F.col("calc_window"), 2))


def verify_payments(payments: DataFrame, transfers: DataFrame, labels: DataFrame, floor: float = 1.0) -> DataFrame:
    """Transfers of listed payment transactions, labelled by recipient.

    A listed transaction without any transfer stays with nulls, so a missing
    payment is visible.
    """
    big = transfers.filter(F.col("amount") >= floor).select("tx_hash", "contract_address", "block_time", "from_addr", "to_addr", "amount")
    named = labels.select(F.col("address").alias("to_addr"), "recipient_label")
    return payments.join(big, "tx_hash", "left").join(named, "to_addr", "left").withColumn(
        "found", F.col("from_addr").isNotNull())


def coverage_problems(
    slices: DataFrame, start: str, end: str, keys: Sequence[str] = (), overlaps: bool = False, tolerate_after: str | None = None,
) -> DataFrame:
    """Problems of [start, end) slices that must cover a window, for every key.

    ``gap`` between slices or before the first one, ``short`` where the last one ends too early, and with ``overlaps`` the days that two slices share.
    Days from ``tolerate_after`` on may be missing: they are still in the future. Slices are put in sequence
    for each key; an empty frame means that the slices cover the window.
    """
    from pyspark.sql import Window

    by = list(keys) or ["_all"]
    s = slices.withColumn("_all", F.lit(0)).select(*by, F.col("slice_start").cast("date").alias("a"), F.col("slice_end").cast("date").alias("b"))
    lo, hi = F.lit(start).cast("date"), F.lit(end if tolerate_after is None else min(end, tolerate_after)).cast("date")
    before = Window.partitionBy(*by).orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    reached = s.withColumn("reach", F.greatest(F.coalesce(F.max("b").over(before), lo), lo))
    row = lambda problem, a, b: (F.lit(problem).alias("problem"), a.alias("from_dt"), b.alias("to_dt"))
    out = reached.filter((F.col("a") > F.col("reach")) & (F.col("reach") < hi)).select(*by, *row("gap", F.col("reach"), F.least(F.col("a"), hi)))
    last = s.groupBy(*by).agg(F.max("b").alias("m"))
    if not keys:  # no slice at all leaves the whole window open
        last = last.select("m").groupBy().agg(F.coalesce(F.max("m"), lo).alias("m")).withColumn("_all", F.lit(0))
    out = out.unionByName(last.filter(F.col("m") < hi).select(*by, *row("short", F.greatest(F.col("m"), lo), hi)))
    if overlaps:
        seen = s.withColumn("reach", F.max("b").over(before))
        out = out.unionByName(seen.filter(F.col("a") < F.col("reach")).select(*by, *row("overlap", F.col("a"), F.least(F.col("b"), F.col("reach")))))
    return out.drop("_all")


def assert_coverage(slices: DataFrame, start: str, end: str) -> DataFrame:
    """:func:`coverage_problems` of one series of slices."""
    return coverage_problems(slices, start, end)


def covered(df: DataFrame, slices: DataFrame, start: str, end: str, **kw) -> DataFrame:
    """``df`` behind a guard in its own plan: any coverage problem of the slices it was made of fails the job that reads it."""
    problems = coverage_problems(slices, start, end, **kw)
    told = F.concat_ws(" ", "problem", F.col("from_dt").cast("string"), F.lit("to"), F.col("to_dt").cast("string"))
    first = problems.agg(F.min(told).alias("told")).scalar()
    guard = F.when(F.coalesce(first, F.lit("")) == "", F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("slices do not cover the window: "), first)).cast("boolean"))
    return df.filter(guard)
