"""One read of the log for many sources.

A rule says which logs a source needs: chain, contract, signatures, indexed topics and time window. All rules
compile into one predicate of literals, so the reader sees addresses, topics, holders and windows
and skips row groups; a log store clustered by :func:`write_clustered` also lets it skip whole files. The same rules
then tag each log that passes with every source and role it plays.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tideledger.functions import codec, wide
from tideledger.session import constant_frame
from tideledger.sources.registry import FULL_RATIO_TOKENS, SHARE_RATE_SERIES, VAULTS, SourceSpec

SLOTS = 64  # address slots of a clustered store
SLOT = "address_slot"
MOVE, CODE, FLOW, IDLE = "move", "code", "flow", "idle"
_EPOCH = date(1970, 1, 1)


def second_of(day: date) -> int:
    return (day - _EPOCH).days * 86400


@dataclass(frozen=True)
class Rule:
    """Logs of one contract that play one role for one source.

    ``one_sided`` keeps only the side of the address in ``topic1`` or ``topic2`` and leaves out its transfers to itself.
    """

    role: str
    source: str
    kind: str  # transfer | stake | referral | swap | flow
    blockchain: str
    address: str
    topic0: tuple[str, ...]
    contract: str
    symbol: str | None
    decimals: int | None
    since: int  # first second
    until: int  # first second after
    topic1: str | None = None
    topic2: str | None = None
    one_sided: bool = False
    ref_code: int | None = None


def topic_of(address: str) -> str:
    return "0x" + address.lower()[2:].rjust(64, "0")


def source_rules(spec: SourceSpec, until: int) -> list[Rule]:
    """Everything the legs and codes of a source come from."""
    out = []
    referrals = (codec.REFERRAL_TOPIC, codec.STAKE_REFERRAL_TOPIC)
    for t in spec.targets:
        token, since = t.address.lower(), second_of(t.start_date)

        def rule(role, kind, topic0, address=token, **kw):
            return Rule(role, spec.name, kind, t.blockchain, address, topic0, token, t.symbol, t.decimals, since, until, **kw)  # noqa: B023

        if t.kind == "holder":
            holder = topic_of(t.holder)
            out += [rule(MOVE, "transfer", (codec.TRANSFER_TOPIC,), one_sided=True, ref_code=t.ref_code, **{side: holder}) for side in ("topic1", "topic2")]
            continue
        moves = (codec.STAKED_TOPIC, codec.WITHDRAWN_TOPIC) if t.kind == "stake" else (codec.TRANSFER_TOPIC,)
        out.append(rule(MOVE, "stake" if t.kind == "stake" else "transfer", moves))
        if t.kind == "swap":
            out.append(rule(CODE, "swap", (codec.SWAP_TOPIC,), t.swap_contract.lower(), topic2=topic_of(token)))
        else:
            out.append(rule(CODE, "referral", referrals))
    return out


def vault_name(chain: str, symbol: str) -> str:
    return f"{chain}/{symbol}"


def series_rules(until: int, vaults: Iterable = VAULTS, single: Mapping = SHARE_RATE_SERIES) -> list[Rule]:
    """Deposits and withdrawals that carry a share rate; ``source`` is the name of the series."""
    kinds = (codec.DEPOSIT_TOPIC, codec.WITHDRAW_TOPIC)
    named = [(name, "ethereum", vault, start) for name, (vault, start) in single.items()]
    named += [(vault_name(chain, symbol), chain, vault, start) for chain, symbol, vault, _u, _n, start in vaults]
    return [Rule(FLOW, name, "flow", chain, vault, kinds, vault, None, None, second_of(start), until) for name, chain, vault, start in named]


def idle_rules(until: int, vaults: Iterable = VAULTS, full_ratio: Iterable[str] = FULL_RATIO_TOKENS) -> list[Rule]:
    """Transfers of the underlying token from or to vaults with a measured ratio; ``source`` is the vault's symbol."""
    return [
        Rule(IDLE, symbol, "transfer", chain, under, (codec.TRANSFER_TOPIC,), under, symbol, decimals, second_of(start), until,
             one_sided=True, **{side: topic_of(vault)})
        for chain, symbol, vault, under, decimals, start in vaults if under and symbol not in full_ratio for side in ("topic1", "topic2")
    ]


def address_slot(address: Column) -> Column:
    return F.pmod(F.crc32(address.cast("binary")), F.lit(SLOTS)).cast("int")


def predicate(rules: Iterable[Rule], columns: Iterable[str] = ()) -> Column:
    """All rules as one condition on literals; addresses that ask for the same logs are listed together."""
    rules = list(rules)
    alike = defaultdict(set)
    for r in rules:
        alike[r.topic0, r.topic1, r.topic2, r.since, r.until].add((r.blockchain, r.address))
    parts = []
    for (topic0, topic1, topic2, since, until), contracts in sorted(alike.items(), key=repr):
        part = F.col("address").isin(*sorted({a for _, a in contracts})) & F.col("blockchain").isin(*sorted({c for c, _ in contracts}))
        part &= F.col("topic0").isin(*topic0)
        for name, wanted in (("topic1", topic1), ("topic2", topic2)):
            if wanted:
                part &= F.col(name) == wanted
        parts.append(part & (F.col("block_time") >= since) & (F.col("block_time") < until))
    if not parts:
        return F.lit(False)
    whole = reduce(Column.__or__, parts)
    if SLOT in columns:  # a clustered store: whole files are skipped by their folder
        whole = F.col(SLOT).isin(*sorted({zlib.crc32(r.address.encode()) % SLOTS for r in rules})) & whole
    return whole


RULE_COLUMNS = (
    "role string, source string, kind string, blockchain string, address string, topic0 string, contract_address string, symbol string, "
    "decimals int, since bigint, until bigint, want1 string, want2 string, one_sided boolean, fixed_code bigint")


def tagged_events(logs: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Decoded logs, one row for each rule that a log meets.

    role, source, blockchain, contract_address, symbol, decimals, tx_hash, block_number, log_index, block_time, from_addr, to_addr,
    amount, owner, ref_code, assets, shares, and amounts that need more than 120 bits in columns named ``_wide``. Stakes and the sides of a
    holder are moves from or to the zero address.
    """
    rules = list(rules)
    rows = [(r.role, r.source, r.kind, r.blockchain, r.address, t0, r.contract, r.symbol, r.decimals, r.since, r.until, r.topic1, r.topic2,
             r.one_sided, r.ref_code) for r in rules for t0 in r.topic0]
    named = constant_frame(logs.sparkSession, rows, T.StructType.fromDDL(RULE_COLUMNS))
    wanted = (F.col("want1").isNull() | (F.col("want1") == F.col("topic1"))) & (F.col("want2").isNull() | (F.col("want2") == F.col("topic2")))
    other = ~F.col("one_sided") | (F.col("topic1") != F.col("topic2"))
    inside = (F.col("block_time") >= F.col("since")) & (F.col("block_time") < F.col("until"))
    hit = logs.filter(predicate(rules, logs.columns)).join(named, ["blockchain", "address", "topic0"]).filter(wanted & other & inside)
    first, second, zero = codec.topic_address(F.col("topic1")), codec.topic_address(F.col("topic2")), F.lit(codec.ZERO_ADDRESS)
    kind, sided, data = F.col("kind"), F.col("one_sided"), F.col("data")
    staked = F.col("topic0") == codec.STAKED_TOPIC
    moves = kind.isin("transfer", "stake")
    sender = F.when(kind == "stake", F.when(staked, zero).otherwise(first)).when(sided & F.col("want2").isNotNull(), zero).otherwise(first)
    receiver = F.when(kind == "stake", F.when(staked, first).otherwise(zero)).when(sided & F.col("want1").isNotNull(), zero).otherwise(second)
    word0 = codec.data_word(data, 0)
    return hit.select(
        "role", "source", "blockchain", "contract_address", "symbol", "decimals", F.col("transaction_hash").alias("tx_hash"),
        "block_number", "log_index", "block_time",
        F.when(moves, sender).alias("from_addr"), F.when(moves, receiver).alias("to_addr"),
        F.when(moves, codec.uint(word0)).alias("amount"), F.when(moves & codec.uint_overflows(word0), wide.limbs(word0)).alias("amount_wide"),
        F.when(kind == "referral", second).when(kind == "swap", codec.topic_address(F.col("topic3"))).alias("owner"),
        F.when(kind == "referral", codec.referral_code(F.col("topic1"))).when(kind == "swap", codec.swap_code(data))
        .otherwise(F.col("fixed_code")).alias("ref_code"),
        *(c for i, name in enumerate(("assets", "shares")) for c in (
            F.when(kind == "flow", codec.uint(codec.data_word(data, i))).alias(name),
            F.when((kind == "flow") & codec.uint_overflows(codec.data_word(data, i)), wide.limbs(codec.data_word(data, i))).alias(f"{name}_wide"))),
    )


def write_clustered(logs: DataFrame, path: str, files: int | None = None) -> None:
    """Store logs so that scans skip what they do not need.

    Folders by chain and address slot, files sorted by contract, signature and indexed topics: folders are
    pruned by the compiled predicate and row groups by their statistics. One busy contract is spread over many files by the range split.
    """
    keyed = logs.withColumn(SLOT, address_slot(F.col("address")))
    order = [SLOT, "address", "topic0", "topic2", "topic1", "block_number"]
    dealt = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    dealt.sortWithinPartitions("blockchain", *order).write.mode("errorifexists").partitionBy("blockchain", SLOT).parquet(path)


def end_of(day: date) -> int:
    """First second after a day."""
    return second_of(day + timedelta(days=1))
