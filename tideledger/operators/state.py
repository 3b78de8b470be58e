"""Balances carried from window to window as a stored, mergeable state.

The state of a wallet is what every later window needs from its past: the exact balance, the code held, and the order keys of
the legs that set them. States of disjoint sets of legs merge in any grouping and order, so a window's state is the state before it
merged with the window's own legs, and logs that arrive late are merged into every state they should have been in.

A window reads one snapshot and its own legs. Snapshots are parts with a completion log: a window whose run died left
no snapshot, and a snapshot rewritten for late logs supersedes the earlier one.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideledger.functions.dates import SECONDS_PER_DAY
from tideledger.operators.twa import DUST, WALLET, balance_intervals, order_key, to_daily
from tideledger.sources import store

STATE = ["net", "code", "code_at", "last_at", "legs"]
_PART = ("state", "balances")


def _second(day: date) -> int:
    return (day - date(1970, 1, 1)).days * SECONDS_PER_DAY


def _exact(amount: Column, kind: str) -> Column:
    """Integers stay integers; floating amounts become decimals, whose sums do not depend on the order."""
    return amount.cast("decimal(38,18)") if kind in ("double", "float") else amount.cast("decimal(38,0)") if not kind.startswith("decimal") else amount


def partial_state(legs: DataFrame, keys: Sequence[str] = WALLET) -> DataFrame:
    """State of a set of legs: one map-side combined, hash-based aggregate."""
    at = order_key()
    coded = F.when(F.col("ref_code").isNotNull(), at)
    amount = _exact(F.col("amount_change"), dict(legs.dtypes)["amount_change"])
    return legs.groupBy(*keys).agg(
        F.sum(amount).alias("net"), F.max_by("ref_code", coded).cast("bigint").alias("code"), F.max(coded).alias("code_at"),
        F.max(at).alias("last_at"), F.count("*").alias("legs"))


def merge_states(*states: DataFrame, keys: Sequence[str] = WALLET) -> DataFrame:
    """The state of all legs behind several states of disjoint sets of legs."""
    rows = reduce(DataFrame.unionByName, states)
    return rows.groupBy(*keys).agg(
        F.sum("net").alias("net"), F.max_by("code", "code_at").alias("code"), F.max("code_at").alias("code_at"),
        F.max("last_at").alias("last_at"), F.sum("legs").alias("legs"))


def opened_legs(state: DataFrame, legs: DataFrame, start: date, keys: Sequence[str] = WALLET, after: DataFrame | None = None) -> DataFrame:
    """A window's legs preceded by one opening leg for each wallet that still holds or acts in it.

    ``after`` is the state at the window's end, if there is one: who acted shows in it without another look at the legs.
    """
    kind = dict(legs.dtypes)["amount_change"]
    holding = F.col("net") > F.lit(DUST)
    # Few rows: a wallet without balance only matters for its code, and only when it comes back.
    gone = state.filter(~holding)
    if after is None:
        back = gone.join(legs.select(*keys), list(keys), "left_semi")
    else:
        back = gone.join(after.select(*keys, F.col("legs").alias("legs_after")), list(keys)).filter(F.col("legs_after") > F.col("legs")).select(*state.columns)
    first = state.filter(holding).unionByName(back).select(
        *keys, F.lit(-1).cast("bigint").alias("block"), F.lit(-1).cast("bigint").alias("log_index"), F.lit(0).alias("leg_seq"),
        F.lit(_second(start)).cast("bigint").alias("ts"), F.col("net").cast(kind).alias("amount_change"), F.col("code").alias("ref_code"))
    return legs.select(*first.columns).unionByName(first)


def of_window(legs: DataFrame, start: date, end: date) -> DataFrame:
    """Legs of [start, end); the bounds are literals, so the reader of stored legs sees them."""
    return legs.filter((F.col("ts") >= F.lit(_second(start))) & (F.col("ts") < F.lit(_second(end))))


def write_state(state: DataFrame, root: str, as_of: date) -> None:
    """Commit the state of everything before ``as_of``; an earlier commit for that day is superseded."""
    spark = state.sparkSession
    plan = spark.createDataFrame([_PART], "source string, target string")
    store.write_parts(state.withColumns({"source": F.lit(_PART[0]), "target": F.lit(_PART[1])}), plan, root, as_of)


def read_state(spark: SparkSession, root: str, as_of: date) -> DataFrame:
    """The newest committed state for a day; an error where there is none."""
    plan = spark.createDataFrame([_PART], "source string, target string")
    rows = store.load_rows(spark, plan, root, as_of)
    if rows is None:
        raise ValueError(f"the state at {as_of} is empty")
    return rows.drop(*store.PART_KEYS)


def stored_days(spark: SparkSession, root: str) -> list[date]:
    """Days with a committed state, oldest first."""
    return [date.fromisoformat(day) for day in store.windows(spark, root)]


def advance(legs: DataFrame, root: str, start: date, end: date, keys: Sequence[str] = WALLET, genesis: bool = False, **kw) -> DataFrame:
    """Daily balances of [start, end) from the state at ``start`` and the window's legs; the state at ``end`` is stored on the way.

    ``genesis`` starts without a past. Otherwise a missing state is an error, never an empty past.
    """
    spark, inside = legs.sparkSession, of_window(legs, start, end)
    new = partial_state(inside, keys)
    if genesis:
        write_state(new, root, end)
        opened = inside.select(*keys, "block", "log_index", "leg_seq", "ts", "amount_change", "ref_code")
    else:
        before = read_state(spark, root, start)
        write_state(merge_states(before, new, keys=keys), root, end)
        opened = opened_legs(before, inside, start, keys, read_state(spark, root, end))
    return to_daily(balance_intervals(opened, date.fromordinal(end.toordinal() - 1), list(keys), **kw))


def apply_late(late: DataFrame, root: str, keys: Sequence[str] = WALLET) -> list[date]:
    """Merge logs that arrived late into every stored state they belong to; returns the days whose state changed.

    A window is to be issued again when the state at its start or at its end is among those days. Late legs must be new: the same
    leg merged twice counts twice.
    """
    spark = late.sparkSession
    first = late.agg(F.min("ts")).first()[0]
    changed = [day for day in stored_days(spark, root) if first is not None and _second(day) > first]
    for day in changed:
        missed = partial_state(late.filter(F.col("ts") < _second(day)), keys)
        write_state(merge_states(read_state(spark, root, day), missed, keys=keys), root, day)
    return changed
