"""Tracked contracts, exclusions, programs and windows.

The tables below are fixed values of the settled methodology: they name which
contracts are tracked and must match exactly for results to match.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, types as T

from tideledger.session import constant_frame

# Settled scan window: events on or after SETTLED_END are out, daily series
# reach LAST_SETTLED_DAY exactly.
SETTLED_END = date(2026, 8, 1)
LAST_SETTLED_DAY = SETTLED_END - timedelta(days=1)

START = date(2024, 9, 1)


@dataclass(frozen=True)
class Target:
    """One tracked contract. ``kind`` says which events carry code and balance."""

    source: str
    kind: str  # transfer | swap | stake | holder
    blockchain: str
    symbol: str
    address: str
    decimals: int
    start_date: date = START
    swap_contract: str | None = None
    holder: str | None = None
    ref_code: int | None = None


# The tracked contracts.
TARGETS: tuple[Target, ...] = (
    Target("susds_eth", "transfer", "ethereum", "sUSDS", "0xa3931d71877c0e7a3148cb7eb4463524fec27fbd", 18),
    Target("susdc", "transfer", "ethereum", "sUSDC", "0xbc65ad17c5c0a2a4d159fa5a503f4992c7b545fe", 18),
    Target("susdc", "transfer", "base", "sUSDC", "0x3128a0f7f0ea68e7b7c9b00afa7e41045828e858", 18),
    Target("susdc", "transfer", "arbitrum", "sUSDC", "0x940098b108fb7d0a7e374f6eded7760787464609", 18),
    Target("susdc", "transfer", "optimism", "sUSDC", "0xcf9326e24ebffbef22ce1050007a43a3c0b6db55", 18),
    Target("susdc", "transfer", "unichain", "sUSDC", "0x14d9143becc348920b68d123687045db49a016c6", 18),
    Target("stusds", "transfer", "ethereum", "stUSDS", "0x99cd4ec3f88a45940936f469e4bb72a2a701eeb9", 18),
    Target("usds_farms", "stake", "ethereum", "USDS-SKY", "0x0650caf159c5a49f711e8169d4336ecb9b950275", 18),
    Target("usds_farms", "stake", "ethereum", "USDS-SPK", "0x173e314c7635b45322cd8cb14f44b312e079f3af", 18),
    Target("usds_farms", "stake", "ethereum", "USDS-CLE", "0x10ab606b067c9c461d8893c47c7512472e19e2ce", 18),
    Target("susds_psm3", "swap", "base", "sUSDS", "0x5875eee11cf8398102fdad704c9e96607675467a", 18,
           swap_contract="0x1601843c5e9bc251a3272907010afa41fa18347e"),
    Target("susds_psm3", "swap", "arbitrum", "sUSDS", "0xddb46999f8891663a8f2828d25298f70416d7610", 18,
           swap_contract="0x2b05f8e1cacc6974fd79a673a341fe1f58d27266"),
    Target("susds_psm3", "swap", "optimism", "sUSDS", "0xb5b2dc7fd34c249f4be7fb1fcea07950784229e0", 18,
           swap_contract="0xe0f9978b907853f354d79188a3defbd41978af62"),
    Target("susds_psm3", "swap", "unichain", "sUSDS", "0xa06b10db9f390990364a3984c04fadf1c13691b5", 18,
           swap_contract="0x7b42ed932f26509465f7ce3faf76ffce1275312f"),
    Target("sp_vaults", "transfer", "ethereum", "spUSDC", "0x28b3a8fb53b741a8fd78c0fb9a6b2393d896a43d", 6),
    Target("sp_vaults", "transfer", "avalanche_c", "spUSDC", "0x28b3a8fb53b741a8fd78c0fb9a6b2393d896a43d", 6),
    Target("sp_vaults", "transfer", "ethereum", "spUSDT", "0xe2e7a17dff93280dec073c995595155283e3c372", 6),
    Target("sp_vaults", "transfer", "ethereum", "spPYUSD", "0x80128dbb9f07b93dde62a6daeadb69ed14a7d354", 6),
    Target("sp_vaults", "transfer", "ethereum", "spETH", "0xfe6eb3b609a7c8352a241f7f3a21cea4e9209b8f", 18),
    Target("usds_aave", "holder", "ethereum", "USDS", "0xdc035d45d973e3ec169d2276ddab16f1e407384f", 18,
           holder="0x32a6268f9ba3642dda7892add74f1d34469a4259", ref_code=9001),
    Target("usds_ref4001", "holder", "ethereum", "USDS", "0xdc035d45d973e3ec169d2276ddab16f1e407384f", 18,
           holder="0x1e1d42781fc170ef9da004fb735f56f0276d01b8", ref_code=4001),
)

# Contracts that hold the token for other users.
EXCLUDED_HOLDERS: tuple[str, ...] = (
    "0xbc65ad17c5c0a2a4d159fa5a503f4992c7b545fe",
    "0xbbbbbbbbbb9cc5e90e3b3af64bdaf62c37eeffcb",
    "0xbe3d4ec488a0a042bb86f9176c24f8cd54018ba7",
    "0x00836fe54625be242bcfa286207795405ca4fd10",
)

# L2 holders whose default code 0 becomes 10001, per chain.
CONTRACT_HELD_L2: dict[str, tuple[str, ...]] = {
    "base": (
        "0x2917956eff0b5eaf030abdb4ef4296df775009ca",
        "0x3128a0f7f0ea68e7b7c9b00afa7e41045828e858",
        "0x1601843c5e9bc251a3272907010afa41fa18347e",
        "0x2c776041ccfe903071af44aa147368a9c8eea518",
        "0xc3bef21ea7deb5c34cf33e918c8e28972c8048ed",
        "0x1647d5950dee7332f748b5d02ff4abe7ddcaff6b",
    ),
    "arbitrum": (
        "0x92afd6f2385a90e44da3a8b60fe36f6cbe1d8709",
        "0x940098b108fb7d0a7e374f6eded7760787464609",
        "0x2b05f8e1cacc6974fd79a673a341fe1f58d27266",
        "0x6c247b1f6182318877311737bac0844baa518f5e",
        "0x52aa899454998be5b000ad077a46bbe360f4e497",
    ),
    "optimism": (
        "0x876664f0c9ff24d1aa355ce9f1680ae1a5bf36fb",
        "0xcf9326e24ebffbef22ce1050007a43a3c0b6db55",
        "0xe0f9978b907853f354d79188a3defbd41978af62",
    ),
    "unichain": (
        "0x345e368fccd62266b3f5f37c9a131fd1c39f5869",
        "0x14d9143becc348920b68d123687045db49a016c6",
        "0x7b42ed932f26509465f7ce3faf76ffce1275312f",
    ),
}


@dataclass(frozen=True)
class DeliveryProgram:
    """A program whose contracts deliver the token to end users."""

    name: str
    ref_code: int
    contracts: tuple[str, ...]
    start: date | None = None
    end: date | None = None  # exclusive


# The delivery program and the codes moved on to end recipients.
SETTLEMENT_PROGRAM = DeliveryProgram(
    "settlement", 1003, ("0x9008d19f58aabd9ed0d60971565aa8510560ab41",)
)
REROUTED_CODES: tuple[int, ...] = (1004, 4011)
MIN_INTERMEDIARY_EVENTS = 3
MAX_VALID_CODE = 1_000_000_000
CANARY_FLOOR_UNITS = 10**18

# Vaults with their underlying token and series start.
# (blockchain, symbol, vault, underlying, underlying decimals, start)
VAULTS: tuple[tuple[str, str, str, str | None, int | None, date], ...] = (
    ("ethereum", "spUSDC", "0x28b3a8fb53b741a8fd78c0fb9a6b2393d896a43d",
     "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48", 6, date(2025, 10, 1)),
    ("ethereum", "spUSDT", "0xe2e7a17dff93280dec073c995595155283e3c372",
     "0xdac17f958d2ee523a2206206994597c13d831ec7", 6, date(2025, 10, 1)),
    ("ethereum", "spPYUSD", "0x80128dbb9f07b93dde62a6daeadb69ed14a7d354",
     "0x6c3ea9036406852006290770bedfcaba0e23a0e8", 6, date(2025, 12, 1)),
    ("avalanche_c", "spUSDC", "0x28b3a8fb53b741a8fd78c0fb9a6b2393d896a43d",
     "0xb97ef9ef8734c71904d8002f8b6bc66dd9c48a6e", 6, date(2025, 10, 8)),
    ("ethereum", "spETH", "0xfe6eb3b609a7c8352a241f7f3a21cea4e9209b8f", None, None, date(2025, 10, 1)),
)
FULL_RATIO_TOKENS: tuple[str, ...] = ("spUSDT", "spPYUSD")
ZERO_REWARD_TOKENS: tuple[str, ...] = ("spETH",)

# Single-vault conversion series (vault, first day).
SHARE_RATE_SERIES: dict[str, tuple[str, date]] = {
    "susds": ("0xa3931d71877c0e7a3148cb7eb4463524fec27fbd", date(2024, 9, 4)),
    "stusds": ("0x99cd4ec3f88a45940936f469e4bb72a2a701eeb9", date(2025, 8, 25)),
}

TARGET_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("blockchain", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("contract_address", T.StringType()),
    T.StructField("decimals", T.IntegerType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("swap_contract", T.StringType()),
    T.StructField("holder", T.StringType()),
    T.StructField("holder_code", T.LongType()),
])
PROGRAM_SCHEMA = T.StructType([
    T.StructField("program_contract", T.StringType()),
    T.StructField("program_code", T.LongType()),
    T.StructField("program_start", T.DateType()),
    T.StructField("program_end", T.DateType()),
])


def targets_frame(spark: SparkSession, targets: Iterable[Target] = TARGETS) -> DataFrame:
    rows = [
        (t.source, t.kind, t.blockchain, t.symbol, t.address.lower(), t.decimals, t.start_date,
         t.swap_contract, t.holder, t.ref_code)
        for t in targets
    ]
    return constant_frame(spark, rows, TARGET_SCHEMA)


def programs_frame(spark: SparkSession, programs: Iterable[DeliveryProgram]) -> DataFrame:
    """One row per program contract; a later program takes a shared contract."""
    by_contract = {c.lower(): (c.lower(), p.ref_code, p.start, p.end) for p in programs for c in p.contracts}
    return constant_frame(spark, by_contract.values(), PROGRAM_SCHEMA)


@dataclass(frozen=True)
class SourceSpec:
    """How the legs of one source are built."""

    name: str
    excluded: tuple[str, ...] = ()
    programs: tuple[DeliveryProgram, ...] = ()
    reroute: tuple[int, ...] = ()
    targets: tuple[Target, ...] = field(default=())


def _spec(name: str, **kw) -> SourceSpec:
    return SourceSpec(name, targets=tuple(t for t in TARGETS if t.source == name), **kw)


SOURCES: dict[str, SourceSpec] = {
    s.name: s
    for s in (
        _spec("susds_eth", excluded=EXCLUDED_HOLDERS, programs=(SETTLEMENT_PROGRAM,), reroute=REROUTED_CODES),
        _spec("susdc", excluded=EXCLUDED_HOLDERS),
        _spec("stusds"),
        _spec("usds_farms"),
        _spec("susds_psm3", excluded=EXCLUDED_HOLDERS),
        _spec("sp_vaults"),
        _spec("usds_aave"),
        _spec("usds_ref4001"),
    )
}
