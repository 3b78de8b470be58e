"""Who is credited with a transaction: real codes, deliveries, re-routed codes.

All maps share one shape: one row per (blockchain, contract_address, tx_hash,
user_addr) with the deciding ``log_index``, the ``ref_code`` and its ``kind``.
Grouping is always by transaction, whose size the chain bounds, so no group can
grow with the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideledger.functions import wide
from tideledger.functions.codec import ZERO_ADDRESS
from tideledger.functions.dates import day_of
from tideledger.sources.registry import CANARY_FLOOR_UNITS, MAX_VALID_CODE, MIN_INTERMEDIARY_EVENTS

TOKEN = ["blockchain", "contract_address"]
TX = TOKEN + ["tx_hash"]
WALLET_TX = TX + ["user_addr"]

# A code signal of a higher rank decides over any of a lower one.
RANK = {"real": 3, "rerouted": 2, "delivery": 1}
_INDEX_BITS = 40


def signal(kind: Column, log_index: Column) -> Column:
    """Order of code signals as one integer: rank first, then log index.

    A plain integer keeps the latest-code aggregates hash-based.
    """
    rank = F.lit(0)
    for name, r in RANK.items():
        rank = F.when(kind == name, F.lit(r)).otherwise(rank)
    return F.shiftleft(rank.cast("bigint"), _INDEX_BITS) + log_index


def _latest(df: DataFrame, keys: list[str], kind: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.max("log_index").alias("log_index"),
        F.max_by("ref_code", "log_index").alias("ref_code"),
    ).withColumn("kind", F.lit(kind))


def real_codes(referrals: DataFrame) -> DataFrame:
    """Latest code named for each (transaction, owner)."""
    named = referrals.filter(F.col("tx_hash").isNotNull()).withColumnRenamed("owner", "user_addr")
    return _latest(named, WALLET_TX, "real")


def swap_codes(swaps: DataFrame, tracked: DataFrame | str) -> DataFrame:
    """Latest well-formed code per (transaction, receiver) of swaps into the token.

    ``tracked`` is one token address, or a frame (blockchain, contract_address,
    swap_contract) when swaps of several chains are read together.
    """
    if isinstance(tracked, str):
        into = swaps.filter(F.col("asset_out") == tracked).withColumn("contract_address", F.lit(tracked))
    else:
        pairs = tracked.select("blockchain", F.col("contract_address").alias("asset_out"),
                               F.col("swap_contract").alias("contract_address"))
        into = swaps.join(pairs, ["blockchain", "contract_address", "asset_out"], "left_semi").withColumn(
            "contract_address", F.col("asset_out"))
    valid = into.filter(F.col("tx_hash").isNotNull() & (F.col("ref_code") < MAX_VALID_CODE))
    return _latest(valid.withColumnRenamed("receiver", "user_addr"), WALLET_TX, "real")


def wallet_sides(transfers: DataFrame, *extra: Column) -> DataFrame:
    """Both sides of every transfer as (wallet, signed amount); no zero address.

    ``leg_seq`` 0 is the receiving side, so a self-transfer has a fixed order. Where transfers carry wide amounts, ``delta_wide``
    has those that do not fit ``delta``.
    """
    def side(address: str, sign: int) -> Column:
        amount = F.col("amount") if sign > 0 else -F.col("amount")
        more = []
        if "amount_wide" in transfers.columns:
            more = [F.when(F.col("amount_wide").isNotNull(), wide.times(F.col("amount_wide"), sign)).cast(wide.TYPE).alias("delta_wide")]
        return F.struct(F.col(address).alias("user_addr"), amount.alias("delta"), F.lit(int(sign < 0)).alias("leg_seq"), *more)

    sides = F.array(side("to_addr", 1), side("from_addr", -1))
    return (
        transfers.withColumn("_side", F.explode(sides))
        .select(*TX, "block_number", "log_index", "block_time", *extra, "_side.*")
        .filter(F.col("user_addr") != ZERO_ADDRESS)
    )


def net_changes(transfers: DataFrame) -> DataFrame:
    """Exact net change per (transaction, wallet)."""
    return (
        wallet_sides(transfers.filter(F.col("tx_hash").isNotNull()))
        .groupBy(*WALLET_TX)
        .agg(F.sum("delta").alias("net"))
    )


def flag_deliveries(transfers: DataFrame, programs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mark transfers that deliver from a program contract to an outside wallet.

    A log without a transaction hash is never a delivery. With ``keys`` a program only counts for rows that agree in them.
    """
    sender = programs.withColumnRenamed("program_contract", "from_addr")
    receiver = programs.select(*keys, F.col("program_contract").alias("to_addr"), F.lit(True).alias("to_program"))
    day = day_of(F.col("block_time"))
    open_window = (F.col("program_start").isNull() | (day >= F.col("program_start"))) & (
        F.col("program_end").isNull() | (day < F.col("program_end"))
    )
    flagged = transfers.join(sender, [*keys, "from_addr"], "left").join(receiver, [*keys, "to_addr"], "left")
    is_delivery = (
        F.col("tx_hash").isNotNull()
        & F.col("program_code").isNotNull()
        & open_window
        & (F.col("to_addr") != ZERO_ADDRESS)
        & F.col("to_program").isNull()
    )
    return flagged.withColumn("delivery_code", F.when(is_delivery, F.col("program_code"))).drop(
        "program_code", "program_start", "program_end"
    )


def _program_parties(transfers: DataFrame, programs: DataFrame) -> DataFrame:
    """Per (transaction, wallet) of delivery transactions: net, tag and mint flag."""
    flagged = flag_deliveries(transfers, programs)
    touched = flagged.filter(F.col("delivery_code").isNotNull()).select(*TX).distinct()
    inside = flagged.join(touched, TX, "left_semi")
    receives = F.col("leg_seq") == 0
    tagged = F.when(receives, F.col("delivery_code"))
    minted = receives & (F.col("from_addr") == ZERO_ADDRESS) & F.col("to_program").isNull()
    sides = wallet_sides(inside, F.col("delivery_code"), F.col("from_addr"), F.col("to_program"))
    return sides.groupBy(*WALLET_TX).agg(
        F.sum("delta").alias("net"),
        F.max(F.when(tagged.isNotNull(), F.col("log_index"))).alias("log_index"),
        F.max_by(tagged, F.when(tagged.isNotNull(), F.col("log_index"))).alias("ref_code"),
        F.max(minted).alias("minted"),
    )


def delivery_codes(transfers: DataFrame, programs: DataFrame) -> DataFrame:
    """Codes from program deliveries to wallets that keep what they received.

    A wallet counts only when its exact net change over the whole transaction is
    positive, which leaves out everyone who just forwards. The latest delivery
    decides.
    """
    kept = _program_parties(transfers, programs).filter(F.col("ref_code").isNotNull() & (F.col("net") > 0))
    return kept.select(*WALLET_TX, "log_index", "ref_code", F.lit("delivery").alias("kind"))


def untagged_mint_recipients(
    transfers: DataFrame, programs: DataFrame, floor: int = CANARY_FLOOR_UNITS
) -> DataFrame:
    """Wallets minted to inside delivery transactions that keep more than the floor
    and got no code: the case delivery tagging cannot see, reported as data."""
    missed = _program_parties(transfers, programs).filter(
        F.col("minted") & F.col("ref_code").isNull() & (F.col("net") > F.lit(floor))
    )
    return missed.select(*WALLET_TX, "net")


def rerouted_codes(
    referrals: DataFrame,
    transfers: DataFrame,
    codes: Iterable[int],
    min_owner_events: int = MIN_INTERMEDIARY_EVENTS,
) -> DataFrame:
    """Move listed codes from an intermediary owner to the wallets it paid.

    An owner is an intermediary when it owns a listed code in enough events. Its
    code moves only when its net change in the transaction is not positive, and
    only to wallets it sent to that are net positive and no owners themselves.
    """
    listed = referrals.filter(F.col("ref_code").isin(*codes) & F.col("tx_hash").isNotNull())
    owners = (
        listed.groupBy(*TOKEN, "owner").agg(F.count("*").alias("n")).filter(F.col("n") >= min_owner_events)
    )
    owned = listed.join(owners, TOKEN + ["owner"], "left_semi").select(
        *TX, F.col("owner").alias("user_addr"), F.col("ref_code").alias("owner_code"), F.col("log_index").alias("owner_at"))
    # One row per (transaction, wallet): its net change, the code it owns, and from whom it received.
    inside = transfers.join(listed.select(*TX), TX, "left_semi")
    received = F.when(F.col("leg_seq") == 0, F.struct("log_index", "from_addr"))
    sides = wallet_sides(inside, F.col("from_addr")).select(*WALLET_TX, "delta", received.alias("received"))
    parties = sides.unionByName(owned, allowMissingColumns=True).groupBy(*WALLET_TX).agg(
        F.coalesce(F.sum("delta"), F.lit(0)).alias("net"), F.max_by("owner_code", "owner_at").alias("owner_code"),
        F.collect_list("received").alias("received"),
    )
    pays = F.col("owner_code").isNotNull() & (F.col("net") <= 0)
    payers = F.collect_list(F.when(pays, F.struct("user_addr", "owner_code"))).over(Window.partitionBy(*TX))
    keeps = F.col("owner_code").isNull() & (F.col("net") > 0)
    paid = F.flatten(F.transform("received", lambda r: F.transform(
        F.filter("payers", lambda p: p["user_addr"] == r["from_addr"]),
        lambda p: F.struct(r["log_index"].alias("log_index"), p["owner_code"].alias("ref_code")))))
    moved = parties.withColumn("payers", payers).filter(keeps).withColumn("latest", F.array_max(paid)).filter(F.col("latest").isNotNull())
    return moved.select(*WALLET_TX, "latest.log_index", "latest.ref_code", F.lit("rerouted").alias("kind"))


def merge_codes(*maps: DataFrame) -> DataFrame:
    """One code per (transaction, wallet): by rank of kind, then by log index."""
    out = None
    for m in maps:
        part = m.select(*WALLET_TX, "log_index", "ref_code", "kind")
        out = part if out is None else out.unionByName(part)
    marked = out.withColumn("signal", signal(F.col("kind"), F.col("log_index")))
    best = marked.groupBy(*WALLET_TX).agg(F.max("signal").alias("signal"), F.max_by("ref_code", "signal").alias("ref_code"))
    kind = F.lit(None).cast("string")
    for name, r in RANK.items():
        kind = F.when(F.shiftright("signal", _INDEX_BITS) == r, F.lit(name)).otherwise(kind)
    index = F.col("signal") - F.shiftleft(F.shiftright("signal", _INDEX_BITS), _INDEX_BITS)
    return best.select(*WALLET_TX, index.alias("log_index"), "ref_code", kind.alias("kind"))


def attribution(
    transfers: DataFrame,
    real: DataFrame,
    referrals: DataFrame | None = None,
    programs: DataFrame | None = None,
    reroute: Iterable[int] = (),
) -> DataFrame:
    """Full attribution map of one or several tokens."""
    maps = [real]
    if reroute and referrals is not None:
        maps.append(rerouted_codes(referrals, transfers, reroute))
    if programs is not None:
        maps.append(delivery_codes(transfers, programs))
    return merge_codes(*maps) if len(maps) > 1 else real


# --- wallet sets used by single-code studies ---------------------------------

NET_FLOOR = 1e-4


def moving_sides(transfers: DataFrame) -> DataFrame:
    """Signed sides without self-transfers."""
    return wallet_sides(transfers.filter(F.col("to_addr") != F.col("from_addr")))


def code_net_recipients(
    referrals: DataFrame, transfers: DataFrame, code: int, floor: float = NET_FLOOR
) -> DataFrame:
    """Net-positive wallets of every transaction that names the code."""
    txs = referrals.filter(F.col("ref_code") == code).select(*TX).distinct()
    return (
        moving_sides(transfers.join(txs, TX, "left_semi"))
        .groupBy(*WALLET_TX)
        .agg(F.sum("delta").alias("net"))
        .filter(F.col("net") > F.lit(floor))
    )


def wallet_set(
    strategy: str,
    referrals: DataFrame,
    transfers: DataFrame,
    code: int,
    routers: Sequence[str] = (),
    contracts: DataFrame | None = None,
    floor: float = NET_FLOOR,
) -> DataFrame:
    """Wallets a code is studied for.

    ``net_recipients``     net-positive wallets of the code's transactions, less routers
    ``owners``             owners named by the code's events
    ``non_contracts``      net-positive wallets that are no known contract
    ``owners_recipients``  owners plus every recipient in the code's transactions
    """
    tagged = referrals.filter(F.col("ref_code") == code)
    owners = tagged.select(*TOKEN, F.col("owner").alias("user_addr"))
    if strategy == "owners":
        return owners.distinct()
    if strategy == "owners_recipients":
        inside = transfers.join(tagged.select(*TX).distinct(), TX, "left_semi").filter(
            (F.col("to_addr") != ZERO_ADDRESS) & (F.col("to_addr") != F.col("from_addr"))
        )
        return owners.union(inside.select(*TOKEN, F.col("to_addr").alias("user_addr"))).distinct()
    net = code_net_recipients(referrals, transfers, code, floor).select(*TOKEN, "user_addr")
    if strategy == "net_recipients":
        net = net.filter(~F.col("user_addr").isin(list(routers)))
    elif strategy != "non_contracts":
        raise ValueError(f"unknown strategy {strategy}")
    elif contracts is not None:
        net = net.join(contracts.select("user_addr"), "user_addr", "left_anti").select(*TOKEN, "user_addr")
    return net.distinct()


def studied_legs(
    referrals: DataFrame,
    transfers: DataFrame,
    wallets: DataFrame,
    receive_code_txs: DataFrame | None = None,
    receive_code: int | None = None,
) -> DataFrame:
    """Legs of the studied wallets with a two-level code lookup.

    The wallet's own code in the transaction comes first, else the latest code
    anyone got in it. ``receive_code_txs`` adds a last resort for receiving legs.
    """
    sides = moving_sides(transfers).join(wallets, TOKEN + ["user_addr"], "left_semi")
    own = real_codes(referrals).join(wallets, TOKEN + ["user_addr"], "left_semi")
    any_code = referrals.groupBy(*TX).agg(F.max_by("ref_code", "log_index").alias("tx_code"))
    legs = sides.join(
        own.select(*WALLET_TX, F.col("ref_code").alias("own_code")), WALLET_TX, "left"
    ).join(any_code, TX, "left")
    options = [F.col("own_code"), F.col("tx_code")]
    if receive_code_txs is not None:
        legs = legs.join(receive_code_txs.select(*TX).distinct().withColumn("in_list", F.lit(True)), TX, "left")
        options.append(F.when((F.col("leg_seq") == 0) & F.col("in_list"), F.lit(receive_code).cast("bigint")))
    return legs.select(
        *TX, "user_addr", F.col("block_number").alias("block"), "log_index", "leg_seq",
        F.col("block_time").alias("ts"), F.col("delta").alias("amount_change"),
        F.coalesce(*options).alias("ref_code"),
    )


def sticky_program_legs(
    events: DataFrame, transfers: DataFrame, referrals: DataFrame, program_code: int
) -> DataFrame:
    """Legs of wallets a program ever credited, under a sticky tag.

    ``events`` are (transaction, wallet) pairs the program credited. The program's
    code is set by those pairs and ended only by a later non-zero real code.
    """
    credited = events.select(*WALLET_TX).distinct()
    wallets = credited.select(*TOKEN, "user_addr").distinct()
    nonzero = real_codes(
        referrals.filter((F.col("ref_code") != 0) & (F.col("ref_code") < MAX_VALID_CODE))
    ).select(*WALLET_TX, F.col("ref_code").alias("real_code"))
    sides = moving_sides(transfers).join(wallets, TOKEN + ["user_addr"], "left_semi")
    return (
        sides.join(credited.withColumn("credited", F.lit(True)), WALLET_TX, "left")
        .join(nonzero, WALLET_TX, "left")
        .select(
            *TX, "user_addr", F.col("block_number").alias("block"), "log_index", "leg_seq",
            F.col("block_time").alias("ts"), F.col("delta").alias("amount_change"),
            F.coalesce(F.when(F.col("credited"), F.lit(program_code).cast("bigint")), F.col("real_code")).alias("ref_code"),
        )
    )


def routed_transactions(
    referrals: DataFrame, transfers: DataFrame, code: int, floor: float = NET_FLOOR
) -> DataFrame:
    """Each event of a code with every wallet its transaction moved, and whether
    the wallet is the named owner (direct) or someone else (routed)."""
    events = referrals.filter(F.col("ref_code") == code)
    net = (
        moving_sides(transfers.join(events.select(*TX).distinct(), TX, "left_semi"))
        .groupBy(*WALLET_TX)
        .agg(F.sum("delta").alias("net"))
        .filter(F.abs("net") > F.lit(floor))
        .withColumnRenamed("user_addr", "net_recipient")
    )
    flow = F.when(F.col("net_recipient") == F.col("owner"), F.lit("direct")).otherwise(F.lit("routed"))
    return events.join(net, TX).withColumn("flow_type", flow)
