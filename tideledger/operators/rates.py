"""Reward-rate schedules: fixed tiers, observed-rate periods and their lookup."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tideledger.functions.dates import SECONDS_PER_DAY, day_of
from tideledger.session import constant_frame
from tideledger.functions.rates import annualised_daily_rate, per_second_to_apy

# Fixed values: (reward_code, description, apy, first day, last day inclusive).
REWARD_SCHEDULE: tuple[tuple[str, str, float, date, date], ...] = (
    ("XR", "Accessibility Rewards (sUSDS/USDS-SKY/USDS-SPK)", 0.006, date(2024, 1, 1), date(2025, 12, 31)),
    ("XR", "Accessibility Rewards (sUSDS/USDS-SKY/USDS-SPK)", 0.005, date(2026, 1, 1), date(2026, 7, 8)),
    ("XR", "Accessibility Rewards (sUSDS/USDS-SKY/USDS-SPK)", 0.002, date(2026, 7, 9), date(2030, 12, 31)),
    ("XR-stUSDS", "Accessibility Rewards (stUSDS)", 0.006, date(2024, 1, 1), date(2025, 12, 31)),
    ("XR-stUSDS", "Accessibility Rewards (stUSDS)", 0.001, date(2026, 1, 1), date(2030, 12, 31)),
    ("XR*", "Accessibility Rewards Alternative (spUSDC/spUSDT/spPYUSD/spETH)", 0.006, date(2024, 1, 1), date(2025, 12, 31)),
    ("XR*", "Accessibility Rewards Alternative (spUSDC/spUSDT/spPYUSD/spETH)", 0.002, date(2026, 1, 1), date(2030, 12, 31)),
)
# Rate class of each token; others count as the default class.
TOKEN_REWARD_CODE: dict[str, str] = {
    "stUSDS": "XR-stUSDS",
    "sUSDS": "XR", "sUSDC": "XR",
    "USDS-SKY": "XR", "USDS-SPK": "XR", "USDS-CLE": "XR",
    "spUSDC": "XR*", "spUSDT": "XR*", "spPYUSD": "XR*", "spETH": "XR*",
}
DEFAULT_REWARD_CODE = "XR"
OPEN_END = date(2030, 12, 31)

# Spread over the observed rate per (class, rule period).
DYNAMIC_CLASSES: tuple[tuple[str, str], ...] = (
    ("SR", "Savings Rate"), ("AR", "Agent Rate"), ("AR*", "Agent Rate Alternative"), ("BR", "Base Rate"),
)
RULE_PERIODS: tuple[tuple[date, date, bool], ...] = (
    (date(2024, 1, 1), date(2025, 12, 31), True), (date(2026, 1, 1), date(2030, 12, 31), False),
)
SPREADS: dict[tuple[str, bool], float] = {
    ("SR", True): 0.0, ("SR", False): 0.0,
    ("AR", True): 0.006, ("AR", False): 0.002,
    ("AR*", True): 0.002,
    ("BR", True): 0.003, ("BR", False): 0.003,
}

SCHEDULE_SCHEMA = T.StructType([
    T.StructField("reward_code", T.StringType()),
    T.StructField("reward_description", T.StringType()),
    T.StructField("apy", T.DoubleType()),
    T.StructField("start_dt", T.DateType()),
    T.StructField("end_dt", T.DateType()),
])


def schedule(spark: SparkSession, rows: Iterable[Sequence] = REWARD_SCHEDULE) -> DataFrame:
    """Fixed tiers with their annualised daily rate."""
    tiers = constant_frame(spark, rows, SCHEDULE_SCHEMA)
    return tiers.withColumn("reward_per", annualised_daily_rate(F.col("apy")))


def reward_code(token: Column) -> Column:
    """Rate class of a token."""
    out = None
    for symbol, code in TOKEN_REWARD_CODE.items():
        out = F.when(token == symbol, F.lit(code)) if out is None else out.when(token == symbol, F.lit(code))
    return out.otherwise(F.lit(DEFAULT_REWARD_CODE))


def with_daily_rate(daily: DataFrame, rates: DataFrame, missing: str = "zero") -> DataFrame:
    """Add ``reward_per`` of the row's ``reward_code`` on its ``dt``.

    The class is an equi-key, so the day range is only a filter inside the hash
    join. ``missing="drop"`` leaves out days without a tier, ``"zero"`` keeps them.
    """
    r = rates.select(F.col("reward_code").alias("_code"), F.col("start_dt").alias("_from"),
                     F.col("end_dt").alias("_to"), F.col("reward_per").alias("_rate"))
    match = (F.col("reward_code") == F.col("_code")) & F.col("dt").between(F.col("_from"), F.col("_to"))
    joined = daily.join(r, match, "inner" if missing == "drop" else "left")
    return joined.withColumn("reward_per", F.coalesce("_rate", F.lit(0.0))).drop("_code", "_from", "_to", "_rate")


def _latest_first(ts: str, seq: str) -> Column:
    """Order of observations as one number, so that latest values are hash-based aggregates."""
    return (F.col(ts).cast("decimal(18,0)") * F.lit(Decimal(10**19)) + F.col(seq)).cast("decimal(38,0)")


def _keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """A single series is a keyed one under an empty name."""
    return (df, list(keys)) if keys else (df.withColumn("_series", F.lit("")), ["_series"])


def _slots(df: DataFrame, ts: str, slot_seconds: int) -> DataFrame:
    if SECONDS_PER_DAY % slot_seconds:
        raise ValueError("slot_seconds must divide a day")
    return df.withColumn("slot", F.floor(F.col(ts) / F.lit(slot_seconds))).withColumn("slot_day", F.floor(F.col(ts) / F.lit(SECONDS_PER_DAY)))


def _carried(slots: DataFrame, keys: list[str], value: str, forward: bool) -> DataFrame:
    """Per (series, slot): ``value`` of the slot before it, or after it.

    In two levels: inside a day first, then from day to day, so that a task holds the slots of one day or the days of one series.
    """
    step = F.lag if forward else F.lead
    in_day = Window.partitionBy(*keys, "slot_day").orderBy("slot")
    over_days = Window.partitionBy(*keys).orderBy("slot_day")
    edge = F.max_by(value, "slot") if forward else F.min_by(value, "slot")
    days = slots.groupBy(*keys, "slot_day").agg(edge.alias("_edge"))
    days = days.select(*keys, "slot_day", step("_edge").over(over_days).alias("_other_day"))
    inside = slots.withColumns({"_beside": step(value).over(in_day), "_at_edge": step("slot").over(in_day).isNull()})
    return inside.join(days, [*keys, "slot_day"]).select(
        *keys, "slot", F.when(F.col("_at_edge"), F.col("_other_day")).otherwise(F.col("_beside")).alias("_carried"))


def change_points(
    observations: DataFrame, value: str = "value", ts: str = "ts", seq: str = "seq", slot_seconds: int = 3600, keys: Sequence[str] = (),
) -> DataFrame:
    """Observations whose value differs from the one before, in one series or in each of many.

    Compared inside each time slot first; only the last value of a slot crosses
    slots, by day and then from day to day, so no task ever holds a whole series.
    """
    series, by = _keyed(observations, keys)
    slotted = _slots(series, ts, slot_seconds)
    in_slot = Window.partitionBy(*by, "slot").orderBy(ts, seq)
    last = slotted.groupBy(*by, "slot", "slot_day").agg(F.max_by(value, _latest_first(ts, seq)).alias("_last"))
    before_slot = _carried(last, by, "_last", forward=True)
    marked = slotted.withColumns({
        "_prev": F.lag(value).over(in_slot), "_first": F.row_number().over(in_slot) == 1,
    })
    before = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_prev"))
    return (
        marked.join(before_slot, [*by, "slot"])
        .filter(F.col(value) != F.coalesce(before, F.lit(0)))
        .select(*observations.columns, day_of(F.col(ts)).alias("dt"))
    )


def observed_periods(
    changes: DataFrame, since: date, value: str = "value", ts: str = "ts", seq: str = "seq", slot_seconds: int = 3600, keys: Sequence[str] = (),
) -> DataFrame:
    """Periods between changes of a per-second rate, the last one of each series open-ended.

    A period ends the day before the next change; only slots with changes are
    put in sequence, not the changes themselves.
    """
    series, by = _keyed(changes.filter(F.col("dt") >= F.lit(since)), keys)
    kept = _slots(series, ts, slot_seconds)
    slots = kept.groupBy(*by, "slot", "slot_day").agg(F.min("dt").alias("_first_dt"))
    following = _carried(slots, by, "_first_dt", forward=False)
    in_slot = Window.partitionBy(*by, "slot").orderBy(ts, seq)
    next_dt = F.coalesce("_next_dt", "_carried")
    end = F.when(next_dt.isNull(), F.lit(OPEN_END)).otherwise(F.date_sub(next_dt, 1))
    return (
        kept.withColumn("_next_dt", F.lead("dt").over(in_slot)).join(following, [*by, "slot"])
        .select(*keys, per_second_to_apy(F.col(value)).alias("observed_apy"), F.col("dt").alias("start_date"), end.alias("end_date"))
    )


def dynamic_rates(periods: DataFrame) -> DataFrame:
    """Observed periods cut by the rule periods, one row per rate class.

    The rules are a constant array, so overlapping periods come from an explode
    and a filter instead of a product of two tables.
    """
    rules = F.array(*[
        F.struct(F.lit(code).alias("reward_code"), F.lit(text).alias("reward_description"),
                 F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(SPREADS.get((code, early))).cast("double").alias("spread"))
        for code, text in DYNAMIC_CLASSES for a, b, early in RULE_PERIODS
    ])
    cut = periods.withColumn("r", F.explode(rules)).filter(
        (F.col("start_date") <= F.col("r.b")) & (F.col("end_date") >= F.col("r.a"))
    )
    start = F.greatest(F.col("start_date"), F.col("r.a"))
    base = F.lit(1.0) + F.col("observed_apy")
    apy = base * (F.lit(1.0) + F.col("r.spread")) - F.lit(1.0)
    plain = F.when(F.col("r.spread") == 0.0, F.col("observed_apy")).otherwise(apy)
    rate = F.lit(365.0) * (F.exp(F.log(F.lit(1.0) + plain) / F.lit(365.0)) - F.lit(1.0))
    out = cut.select(
        "r.reward_code", "r.reward_description", start.alias("start_dt"),
        F.least(F.col("end_date"), F.col("r.b")).alias("end_dt"), rate.alias("reward_per"),
    )
    return out.filter(~((F.col("reward_code") == "AR*") & (F.col("start_dt") >= F.lit(date(2026, 1, 1)))))


SCHEDULE = ["reward_code", "reward_description", "start_dt", "end_dt", "reward_per"]
FIXED, OBSERVED, SUBSIDISED = 1, 2, 3  # priorities where periods of one class overlap


def resolved(periods: DataFrame) -> DataFrame:
    """Overlapping periods of each class cut so that every day has one rate.

    ``periods``: the schedule's columns and ``priority``. A sweep over the boundaries of a class: between two of them the same periods are active, and the
    one of the highest priority holds, the latest begun among equals. Neighbouring pieces of one period are joined again.
    """
    valid = periods.filter(F.col("start_dt") <= F.col("end_dt"))
    bounds = valid.select("reward_code", F.explode(F.array("start_dt", F.date_add("end_dt", 1))).alias("a")).distinct()
    by_class = Window.partitionBy("reward_code")
    pieces = bounds.withColumn("b", F.lead("a").over(by_class.orderBy("a"))).filter(F.col("b").isNotNull())
    p = valid.select(F.col("reward_code").alias("_code"), "reward_description", "reward_per", F.col("start_dt").alias("_from"), F.col("end_dt").alias("_to"),
                     (F.col("priority") * 10_000_000 + F.unix_date("start_dt")).alias("_rank"))
    active = pieces.join(p, (F.col("reward_code") == F.col("_code")) & (F.col("_from") <= F.col("a")) & (F.col("_to") >= F.col("a")))
    held = active.groupBy("reward_code", "a", "b").agg(
        F.max("_rank").alias("_rank"), F.max_by("reward_per", "_rank").alias("reward_per"), F.max_by("reward_description", "_rank").alias("reward_description"))
    ordered = by_class.orderBy("a")
    goes_on = (F.lag("_rank").over(ordered) == F.col("_rank")) & (F.lag("b").over(ordered) == F.col("a"))
    runs = held.withColumn("_new", (~F.coalesce(goes_on, F.lit(False))).cast("int")).withColumn("_run", F.sum("_new").over(ordered))
    return runs.groupBy("reward_code", "_run").agg(
        F.max("reward_description").alias("reward_description"), F.min("a").alias("start_dt"), F.date_sub(F.max("b"), 1).alias("end_dt"),
        F.max("reward_per").alias("reward_per")).select(*SCHEDULE)


def full_schedule(spark: SparkSession, periods: DataFrame, subsidised: DataFrame | None = None) -> DataFrame:
    """Dynamic, fixed and subsidised rates in one schedule without two rates on a day of a class."""
    def ranked(df: DataFrame, priority: int) -> DataFrame:
        return df.select(*SCHEDULE, F.lit(priority).alias("priority"))

    out = ranked(dynamic_rates(periods), OBSERVED).unionByName(ranked(schedule(spark), FIXED))
    return resolved(out if subsidised is None else out.unionByName(ranked(subsidised, SUBSIDISED)))
