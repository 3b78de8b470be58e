"""Signed balance-change legs.

A leg is one signed change of one wallet's balance: (blockchain,
contract_address, symbol, user_addr, block, log_index, leg_seq, ts,
amount_change, ref_code). ``leg_seq`` makes the order total when one event
changes a wallet twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tideledger.functions import wide
from tideledger.functions.codec import scaled
from tideledger.functions.dates import day_of
from tideledger.operators.attribution import WALLET_TX, flag_deliveries, signal, wallet_sides

LEG_COLUMNS = ["blockchain", "contract_address", "symbol", "user_addr", "block", "log_index",
               "leg_seq", "ts", "amount_change", "ref_code"]


def in_window(ts: Column, start: Column, end_ts: int | None) -> Column:
    """Scan window: day on or after the start, second before the end."""
    opened = day_of(ts) >= start
    return opened if end_ts is None else opened & (ts < F.lit(end_ts))


def end_second(end: date, cutoff: date | None = None) -> int:
    """Exclusive end of the scan as a unix second, capped at the cutoff."""
    capped = end if cutoff is None else min(end, cutoff)
    return (capped - date(1970, 1, 1)).days * 86400


def _tracked(events: DataFrame, targets: DataFrame, end_ts: int | None) -> DataFrame:
    tracked = targets.select("blockchain", "contract_address", "symbol", "decimals", "start_date")
    return events.join(tracked, ["blockchain", "contract_address"]).filter(
        in_window(F.col("block_time"), F.col("start_date"), end_ts)
    )


def _scaled_side(delta: Column, wide_delta: Column | None, decimals: Column) -> Column:
    """Token units of one signed amount, wide or not."""
    if wide_delta is None:
        return scaled(delta, decimals)
    return F.coalesce(scaled(delta, decimals), wide.as_double(wide.carried(wide_delta)) / F.pow(F.lit(10.0), decimals))


def transfer_legs(
    transfers: DataFrame, codes: DataFrame, targets: DataFrame, end_ts: int | None = None
) -> DataFrame:
    """Two legs per transfer, each with the code its wallet got in the transaction."""
    kept = _tracked(transfers, targets, end_ts)
    sides = wallet_sides(kept, F.col("symbol"), F.col("decimals"))
    named = codes.select(*WALLET_TX, "ref_code")
    return sides.join(named, WALLET_TX, "left").select(
        "blockchain", "contract_address", "symbol", "user_addr", F.col("block_number").alias("block"),
        "log_index", "leg_seq", F.col("block_time").alias("ts"),
        side_units(sides).alias("amount_change"), "ref_code",
    )


def transaction_legs(
    transfers: DataFrame,
    codes: Sequence[DataFrame],
    targets: DataFrame,
    end_ts: int | None = None,
    programs: DataFrame | None = None,
) -> DataFrame:
    """One leg per (transaction, wallet) instead of one per transfer side.

    All events of a transaction share one second, so only the net change and the
    code can reach a time-weighted balance. Transfers and code maps meet in one
    grouping by (transaction, wallet): no join, and fewer rows for everything
    downstream. Delivery programs need nothing else either, because the grouping
    already has the exact net change their rule asks for. Amounts stay exact
    until the final scaling.
    """
    kept = _tracked(transfers, targets, end_ts)
    if programs is None:
        flagged = kept.withColumn("delivery_code", F.lit(None).cast("bigint"))
    else:
        flagged = flag_deliveries(kept, programs)
    merged = merged_sides(flagged, codes)
    # Token facts come back from the small registry, so they are never shuffled.
    facts = targets.select("blockchain", "contract_address", "symbol", "decimals")
    return merged.join(facts, ["blockchain", "contract_address"]).select(
        "blockchain", "contract_address", "symbol", "user_addr", "block", "log_index",
        F.lit(0).alias("leg_seq"), "ts", net_units(merged).alias("amount_change"), "ref_code",
    )


def side_units(sides: DataFrame) -> Column:
    """Token units of the signed amounts of transfer sides, beside a ``decimals`` column."""
    return _scaled_side(F.col("delta"), F.col("delta_wide") if "delta_wide" in sides.columns else None, F.col("decimals"))


def net_units(merged: DataFrame) -> Column:
    """Token units of the net changes of :func:`merged_sides`, beside a ``decimals`` column."""
    return _scaled_side(F.col("net"), F.col("net_wide") if "net_wide" in merged.columns else None, F.col("decimals"))


def merged_sides(moves: DataFrame, codes: Sequence[DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    """Exact net change and code per (transaction, wallet), by further ``keys`` if asked.

    ``moves`` carry ``delivery_code``; ``codes`` are maps of one shape with a ``kind``. A log without a transaction hash belongs to no
    other: it is a transaction of its own. Wallets that are only named, not moved, give no row.
    """
    alone = F.concat_ws(":", F.lit("#"), F.col("block_number"), F.col("log_index"))
    by = [*keys, *WALLET_TX]
    rows = wallet_sides(moves.withColumn("tx_hash", F.coalesce("tx_hash", alone)), F.col("delivery_code"), *map(F.col, keys)).select(
        *by, "block_number", "log_index", "block_time", "delta", *(["delta_wide"] if "amount_wide" in moves.columns else []),
        F.when(F.col("leg_seq") == 0, F.col("delivery_code")).alias("delivery_code"),
    )
    for m in codes:
        rows = rows.unionByName(
            m.select(*by, signal(F.col("kind"), F.col("log_index")).alias("signal"), F.col("ref_code").cast("bigint").alias("ref_code")),
            allowMissingColumns=True,
        )
    named = F.max_by("ref_code", "signal") if codes else F.max(F.lit(None).cast("bigint"))
    delivered = F.max_by("delivery_code", F.when(F.col("delivery_code").isNotNull(), F.col("log_index")))
    merged = rows.groupBy(*by).agg(
        F.max("block_number").alias("block"), F.max("log_index").alias("log_index"),
        F.max("block_time").alias("ts"), F.sum("delta").alias("net"),
        named.alias("named_code"), delivered.alias("delivery_code"),
        *([wide.total(F.coalesce("delta_wide", wide.of(F.col("delta")))).alias("all_limbs"), F.max(F.col("delta_wide").isNotNull()).alias("any_wide")]
          if "delta_wide" in rows.columns else []),
    )
    net = F.col("net")
    out = ["net"]
    gains = net > 0
    if "delta_wide" in rows.columns:
        # A wide side makes the whole sum wide: ordinary sides are limbs too, and the exact difference of two wide ones may be small again.
        whole = wide.carried(F.col("all_limbs"))
        merged = merged.withColumn("net_wide", F.when(F.col("any_wide"), whole))
        gains = F.when(F.col("any_wide"), wide.is_positive(F.col("net_wide"))).otherwise(gains)
        out = [F.when(~F.col("any_wide"), net).alias("net"), "net_wide"]
    code = F.coalesce(F.col("named_code"), F.when(gains, F.col("delivery_code")))
    return merged.filter(F.col("block").isNotNull()).select(*by, "block", "log_index", "ts", *out, code.cast("bigint").alias("ref_code"))


def stake_legs(stakes: DataFrame, codes: DataFrame, targets: DataFrame, end_ts: int | None = None) -> DataFrame:
    """One leg per staking event: in is positive, out is negative."""
    kept = _tracked(stakes, targets, end_ts)
    side = F.when(F.col("sign") < 0, wide.times(F.col("amount_wide"), -1)).otherwise(F.col("amount_wide")) if "amount_wide" in stakes.columns else None
    return kept.join(codes.select(*WALLET_TX, "ref_code"), WALLET_TX, "left").select(
        "blockchain", "contract_address", "symbol", "user_addr", F.col("block_number").alias("block"),
        "log_index", F.lit(0).alias("leg_seq"), F.col("block_time").alias("ts"),
        _scaled_side(F.col("sign") * F.col("amount"), side, F.col("decimals")).alias("amount_change"), "ref_code",
    )


def holder_legs(transfers: DataFrame, holders: DataFrame, end_ts: int | None = None) -> DataFrame:
    """The whole balance of listed contracts under a fixed code each.

    ``holders``: blockchain, contract_address, symbol, decimals, holder,
    holder_code. Self-transfers change nothing and give no leg.
    """
    sides = wallet_sides(transfers.filter(F.col("to_addr") != F.col("from_addr")))
    listed = holders.select("blockchain", "contract_address", "symbol", "decimals",
                            F.lower("holder").alias("user_addr"), F.col("holder_code").alias("ref_code"))
    kept = sides.join(listed, ["blockchain", "contract_address", "user_addr"]).filter(F.col("delta").isNull() | (F.col("delta") != 0))
    if end_ts is not None:
        kept = kept.filter(F.col("block_time") < end_ts)
    return kept.select(
        "blockchain", "contract_address", "symbol", "user_addr", F.col("block_number").alias("block"),
        "log_index", F.lit(0).alias("leg_seq"), F.col("block_time").alias("ts"),
        side_units(sides).alias("amount_change"), "ref_code",
    )


def drop_holders(df: DataFrame, addresses: Sequence[str]) -> DataFrame:
    """Leave out contracts that hold for others; their counterparties stay."""
    if not addresses:
        return df
    return df.filter(~F.lower("user_addr").isin(*[a.lower() for a in addresses]))
