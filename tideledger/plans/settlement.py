"""From event tables to monthly rewards, for one source or all of them."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tideledger.functions.rates import per_day
from tideledger.operators import attribution as at
from tideledger.operators import conversion as cv
from tideledger.operators import legs as lg
from tideledger.operators import monthly as mo
from tideledger.operators import rates as rt
from tideledger.operators.twa import WALLET, balance_intervals, to_daily
from tideledger.session import constant_frame, shared_dir
from tideledger.sources import scan as sc, store
from tideledger.sources.registry import (
    FULL_RATIO_TOKENS, LAST_SETTLED_DAY, MAX_VALID_CODE, SETTLED_END, SHARE_RATE_SERIES, SOURCES, VAULTS, ZERO_REWARD_TOKENS,
    SourceSpec, programs_frame,
)

_ddl = T.StructType.fromDDL


@dataclass(frozen=True)
class Family:
    """How the balances of some sources become rewards."""

    sources: tuple[str, ...]
    rule: mo.Reclass
    conversion: str | None  # susds | stusds | vaults | None
    uses_ratio: bool = False


FAMILIES: dict[str, Family] = {
    "susds_susdc": Family(("susds_eth", "susdc"), mo.reclass_savings, "susds"),
    "stusds": Family(("stusds",), mo.reclass_none, "stusds"),
    "farms": Family(("usds_farms",), mo.reclass_none, None),
    "psm3": Family(("susds_psm3",), mo.reclass_l2(), "susds"),
    "sp": Family(("sp_vaults",), mo.reclass_vaults, "vaults", uses_ratio=True),
    "usds_aave": Family(("usds_aave",), mo.reclass_none, None),
    "usds_ref4001": Family(("usds_ref4001",), mo.reclass_none, None),
}


def fill_day(end: date) -> date:
    """Last day every series of a window reaches (the end is exclusive)."""
    return min(end, SETTLED_END) - timedelta(days=1)


# --- the shared scan ----------------------------------------------------------

def rules_of(specs: Iterable[SourceSpec], end: date, families: Iterable[str] = ()) -> list[sc.Rule]:
    """Every log that sources and the series of their families need."""
    until = lg.end_second(end, SETTLED_END)
    rules = [r for spec in specs for r in sc.source_rules(spec, until)]
    wanted = {FAMILIES[f].conversion for f in families}
    series = [r for r in sc.series_rules(sc.end_of(LAST_SETTLED_DAY)) if r.source in wanted or ("/" in r.source and "vaults" in wanted)]
    idle = sc.idle_rules(sc.end_of(fill_day(end))) if any(FAMILIES[f].uses_ratio for f in families) else []
    return [*rules, *series, *idle]


def scanned(logs: DataFrame, rules: Iterable[sc.Rule], stage: str | None = None) -> DataFrame:
    """The tagged events of one read of the log, stored by role and sorted by source when a folder is given."""
    events = sc.tagged_events(logs, rules)
    if stage is None:
        return events
    dealt = events.hint("rebalance", "role", "source").sortWithinPartitions("role", "source")
    dealt.write.mode("errorifexists").partitionBy("role").parquet(stage)
    return logs.sparkSession.read.schema(events.schema).parquet(stage).select(*events.columns)


def _fixed_code(specs: Iterable[SourceSpec]) -> Column:
    """Code of sources that credit one contract's whole balance, null for the others."""
    out = F.lit(None).cast("bigint")
    for spec in specs:
        for t in spec.targets:
            if t.kind == "holder":
                out = F.when((F.col("source") == spec.name) & (F.col("contract_address") == t.address.lower()), F.lit(t.ref_code)).otherwise(out)
    return out


def tagged_legs(events: DataFrame, specs: Sequence[SourceSpec], include_programs: bool = True) -> DataFrame:
    """Legs of all sources in one grouping by (source, transaction, wallet), from :func:`scanned` events."""
    spark = events.sparkSession
    names = [s.name for s in specs]
    moves = events.filter((F.col("role") == sc.MOVE) & F.col("source").isin(*names)).drop("owner", "ref_code", "assets", "shares", "assets_wide", "shares_wide")
    named = events.filter((F.col("role") == sc.CODE) & F.col("source").isin(*names) & F.col("tx_hash").isNotNull())
    swaps = [s.name for s in specs if s.targets and s.targets[0].kind == "swap"]
    valid = named.filter(~F.col("source").isin(*swaps) | (F.col("ref_code") < MAX_VALID_CODE)) if swaps else named
    maps = [valid.withColumnRenamed("owner", "user_addr").withColumn("kind", F.lit("real"))]
    delivering = [s for s in specs if s.programs] if include_programs else []
    for s in specs if include_programs else ():
        if s.reroute:
            own = F.col("source") == s.name
            maps.append(at.rerouted_codes(named.filter(own), moves.filter(own), s.reroute).withColumn("source", F.lit(s.name)))
    if delivering:
        programs = reduce(DataFrame.unionByName, (programs_frame(spark, s.programs).withColumn("source", F.lit(s.name)) for s in delivering))
        flagged = at.flag_deliveries(moves, programs, ["source"])
    else:
        flagged = moves.withColumn("delivery_code", F.lit(None).cast("bigint"))
    facts = constant_frame(
        spark, sorted({(s.name, t.blockchain, t.address.lower(), t.symbol, t.decimals) for s in specs for t in s.targets}),
        _ddl("source string, blockchain string, contract_address string, symbol string, decimals int"))
    merged = lg.merged_sides(flagged, maps, ["source"]).join(facts, ["source", "blockchain", "contract_address"])
    legs = merged.select(
        "source", "blockchain", "contract_address", "symbol", "user_addr", "block", "log_index", F.lit(0).alias("leg_seq"), "ts",
        lg.net_units(merged).alias("amount_change"), F.coalesce(_fixed_code(specs), F.col("ref_code")).alias("ref_code"))
    # A holder's own side only: the other side of its moves is the zero address already.
    for s in specs:
        if s.excluded:
            legs = legs.filter((F.col("source") != s.name) | ~F.lower("user_addr").isin(*[a.lower() for a in s.excluded]))
    return legs


def source_legs(logs: DataFrame, spec: SourceSpec, end: date = SETTLED_END, include_programs: bool = True) -> DataFrame:
    """Legs of one source from raw logs; all of its targets in one plan."""
    return tagged_legs(scanned(logs, rules_of([spec], end)), [spec], include_programs).drop("source")


def conversions(events: DataFrame, end: date) -> DataFrame:
    """Every conversion series in one frame: series, dt, rate."""
    starts = [(name, start) for name, (_v, start) in SHARE_RATE_SERIES.items()]
    starts += [(sc.vault_name(c, s), d) for c, s, _v, _u, _n, d in VAULTS]
    flows = events.filter(F.col("role") == sc.FLOW).withColumnRenamed("source", "series")
    frame = constant_frame(events.sparkSession, starts, _ddl("series string, start_dt date"))
    return cv.conversion_series(flows, frame, end, ["series"]).select("series", "dt", "rate")


def idle_holdings(events: DataFrame, end: date) -> DataFrame:
    """Daily underlying held by vaults that use the measured ratio (blockchain, vault_symbol, dt, idle)."""
    moves = events.filter(F.col("role") == sc.IDLE)
    sides = at.wallet_sides(moves, F.col("source").alias("symbol"), F.col("decimals"))
    legs = sides.select(
        "blockchain", "symbol", F.col("block_number").alias("block"), "log_index", F.lit(0).alias("leg_seq"), F.col("block_time").alias("ts"),
        lg.side_units(sides).alias("amount_change"))
    return mo.idle_series(legs, end, ["blockchain", "symbol"]).withColumnRenamed("symbol", "vault_symbol")


def family_daily(
    name: str, intervals: DataFrame, conversion: DataFrame | None, idle: DataFrame | None = None,
    rates: DataFrame | None = None,
) -> DataFrame:
    """Priced daily amounts of one family from its balance intervals."""
    family = FAMILIES[name]
    rates = rates if rates is not None else rt.schedule(intervals.sparkSession)
    amounts = mo.interval_amounts(intervals, family.rule)
    ratios = mo.deployment_ratios(mo.vault_totals(amounts), idle) if family.uses_ratio else None
    keys = ["blockchain", "token", "dt"] if family.conversion == "vaults" else ["dt"]
    return mo.daily_rewards(amounts, rates, conversion, keys, ratios)


def _by_family(families: Sequence[str], value) -> Column:
    """``value(family)`` of the row's family, null where it is None."""
    out = F.lit(None)
    for name in families:
        made = value(FAMILIES[name])
        if made is not None:
            out = F.when(F.col("family") == name, made).otherwise(out)
    return out


def family_rewards(amounts: DataFrame, series: DataFrame, idle: DataFrame | None, families: Sequence[str], rates: DataFrame | None = None) -> DataFrame:
    """Priced daily amounts of several families at once; ``family`` is a column and its settings are expressions on it."""
    rates = rates if rates is not None else rt.schedule(amounts.sparkSession)
    rated = rt.with_daily_rate(amounts.withColumn("reward_code", rt.reward_code(F.col("token"))), rates)
    accrued = per_day(F.col("amount"), F.col("reward_per"))
    deployed = [f for f in families if FAMILIES[f].uses_ratio]
    if deployed:
        rated = mo.measured_ratio(rated, idle, ["family"])
        token = F.col("token")
        vault = F.when(token.isin(*ZERO_REWARD_TOKENS), F.lit(0.0)).otherwise(
            F.when(token.isin(*FULL_RATIO_TOKENS), accrued).otherwise(per_day(F.col("amount") * F.col("ratio"), F.col("reward_per"))))
        accrued = F.when(F.col("family").isin(*deployed), vault).otherwise(accrued)
    named = _by_family(families, lambda f: F.concat_ws("/", "blockchain", "token") if f.conversion == "vaults" else F.lit(f.conversion) if f.conversion else None)
    priced = mo.with_conversion(rated.withColumn("tw_reward", accrued).withColumn("series", named.cast("string")), series, ["series", "dt"])
    return priced.withColumn("tw_reward_usd", F.col("tw_reward") * F.col("conversion"))


def settled_months(events: DataFrame, families: Sequence[str], specs: Sequence[SourceSpec], end: date, by: Sequence[str] = ()) -> DataFrame:
    """Monthly rewards of families from :func:`scanned` events: one grouping, one balance prefix, one pricing for all of them.

    Columns: family, ``by``, month, blockchain, token, ref_code, dr_usd, avg_twa_balance. ``by`` may ask for the source.
    """
    last = fill_day(end)
    source_family = {s: f for f in families for s in FAMILIES[f].sources}
    intervals = balance_intervals(tagged_legs(events, specs), last, [*WALLET, "source"])
    family = reduce(lambda out, s: F.when(F.col("source") == s, F.lit(source_family[s])).otherwise(out), source_family, F.lit(None).cast("string"))
    intervals = intervals.withColumn("family", family)

    def rule(symbol: Column, code: Column, user: Column, chain: Column) -> Column:
        out = code
        for name in families:
            out = F.when(F.col("family") == name, FAMILIES[name].rule(symbol, code, user, chain)).otherwise(out)
        return out

    amounts = mo.interval_amounts(intervals, rule, ["family", *by])
    idle = idle_holdings(events, last) if any(FAMILIES[f].uses_ratio for f in families) else None
    return mo.monthly_rewards(family_rewards(amounts, conversions(events, LAST_SETTLED_DAY), idle, families), ["family", *by])


def _specs(families: Iterable[str]) -> list[SourceSpec]:
    return [SOURCES[s] for f in families for s in FAMILIES[f].sources]


def _stage_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tideledger/scan-{uuid.uuid4().hex}"


def family_monthly(logs: DataFrame, name: str, end: date = SETTLED_END) -> DataFrame:
    """Monthly rewards of one family straight from raw logs."""
    return settle(logs, end, (name,)).drop("source")


def settle(logs: DataFrame, end: date = SETTLED_END, families: Iterable[str] = tuple(FAMILIES), stage: str | None = None) -> DataFrame:
    """Monthly rewards of all families, with their source.

    The log is read once, by a predicate that knows every contract, holder, output token and window; the events that pass are stored
    by role in ``stage`` (a new folder under the shared directory, if not given) and everything else reads those.
    """
    families = tuple(families)
    specs = _specs(families)
    events = scanned(logs, rules_of(specs, end, families), stage or _stage_path(logs.sparkSession))
    return settled_months(events, families, specs, end).withColumnRenamed("family", "source")


def _label(source: str, t) -> str:
    return f"{source}_{t.blockchain}_{t.symbol}"


def settle_parts(logs: DataFrame, root: str, end: date = SETTLED_END, families: Iterable[str] = tuple(FAMILIES), stage: str | None = None) -> DataFrame:
    """:func:`settle`, resumable: targets that are committed under ``root`` for this window are neither scanned nor computed again.

    Pending targets of all families are one scan and one job. Vaults are taken whole: their ratio needs the whole supply.
    """
    families, spark = tuple(families), logs.sparkSession

    def compute(todo: DataFrame) -> DataFrame:
        wanted = {r["target"] for r in todo.select("target").distinct().collect()}  # at most the registered targets
        specs = [replace(s, targets=tuple(t for t in s.targets if _label(s.name, t) in wanted)) for s in _specs(families)]
        specs = [s for s in specs if s.targets]
        left = [f for f in families if any(s.name in FAMILIES[f].sources for s in specs)]
        events = scanned(logs, rules_of(specs, end, left), stage or _stage_path(spark))
        months = settled_months(events, left, specs, end, ["source"])
        return months.withColumn("target", F.concat_ws("_", "source", "blockchain", "token")).withColumn("source", F.col("family")).drop("family")

    return store.resume(spark, plan_frame(spark, families), root, end, compute)


def source_daily(logs: DataFrame, source: str, end: date = SETTLED_END, include_programs: bool = True) -> DataFrame:
    """Daily balances of one source in the shared schema."""
    legs = source_legs(logs, SOURCES[source], end, include_programs)
    return to_daily(balance_intervals(legs, fill_day(end)))


def plan_frame(spark: SparkSession, families: Sequence[str] = tuple(FAMILIES)) -> DataFrame:
    """One row per family and tracked target: what a complete run consists of."""
    rows = [
        (name, _label(source, t))
        for name in families for source in FAMILIES[name].sources for t in SOURCES[source].targets
    ]
    return constant_frame(spark, rows, _ddl("source string, target string"))
