"""Raw event logs: scan, decode, timestamps and block lookup."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tideledger.functions import codec, wide

LOG_SCHEMA = T.StructType([
    T.StructField("blockchain", T.StringType()),
    T.StructField("block_number", T.LongType()),
    T.StructField("log_index", T.LongType()),
    T.StructField("block_time", T.LongType()),
    T.StructField("address", T.StringType()),
    T.StructField("topic0", T.StringType()),
    T.StructField("topic1", T.StringType()),
    T.StructField("topic2", T.StringType()),
    T.StructField("topic3", T.StringType()),
    T.StructField("data", T.StringType()),
    T.StructField("transaction_hash", T.StringType()),
])
LOG_KEY = ["blockchain", "block_number", "log_index"]


def _selection(sel: Mapping[str, Sequence]) -> Column:
    parts: list[Column] = []
    if sel.get("address"):
        parts.append(F.col("address").isin(*[a.lower() for a in sel["address"]]))
    for position, wanted in enumerate(sel.get("topics", ())):
        if wanted:
            parts.append(F.col(f"topic{position}").isin(*wanted))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def select_logs(
    logs: DataFrame,
    selections: Iterable[Mapping[str, Sequence]],
    from_block: int | None = None,
    to_block: int | None = None,
) -> DataFrame:
    """Logs matching any selection within an inclusive block range.

    A selection is ``{"address": [...], "topics": [[...], [], ...]}``; an empty
    topic position matches everything. All of it is literal predicates, so the
    parquet scan prunes row groups when logs are sorted by address and topic.
    """
    out = logs.filter(reduce(lambda a, b: a | b, [_selection(s) for s in selections]))
    if from_block is not None:
        out = out.filter(F.col("block_number") >= from_block)
    if to_block is not None:
        out = out.filter(F.col("block_number") <= to_block)
    return out


def dedupe_logs(logs: DataFrame) -> DataFrame:
    """One row per log when overlapping captures are put together."""
    return logs.dropDuplicates(LOG_KEY)


def attach_block_time(logs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Add ``block_time``; a log of an unknown block fails the job."""
    known = blocks.select("blockchain", "block_number", F.col("block_time").alias("_known"))
    missing = F.raise_error(
        F.concat(F.lit("no timestamp for block "), F.col("block_number").cast("string"))
    ).cast("bigint")
    return (
        logs.drop("block_time")
        .join(known, ["blockchain", "block_number"], "left")
        .withColumn("block_time", F.coalesce(F.col("_known"), missing))
        .drop("_known")
    )


def block_at_or_before(blocks: DataFrame, ts: int, chains: DataFrame | None = None) -> DataFrame:
    """Last block of each chain at or before a second.

    Clamps at the newest known block. With ``chains`` every listed chain gets a
    row, and a chain that starts later gets block 0 (scan from genesis).
    """
    found = (
        blocks.filter(F.col("block_time") <= ts)
        .groupBy("blockchain")
        .agg(F.max("block_number").alias("block_number"))
    )
    if chains is None:
        return found
    return chains.join(found, "blockchain", "left").withColumn(
        "block_number", F.coalesce("block_number", F.lit(0).cast("bigint"))
    )


def _amount(word: Column, name: str) -> list[Column]:
    """An exact amount: a decimal where it fits, else null beside the same value in wide limbs."""
    return [codec.uint(word).alias(name), F.when(codec.uint_overflows(word), wide.limbs(word)).alias(f"{name}_wide")]


def _common() -> list[Column]:
    return [F.col("blockchain"), F.col("address").alias("contract_address"),
            F.col("transaction_hash").alias("tx_hash"), F.col("block_number"), F.col("log_index"), F.col("block_time")]


def transfers(logs: DataFrame) -> DataFrame:
    """Transfer events with the exact raw value."""
    return logs.filter(F.col("topic0") == codec.TRANSFER_TOPIC).select(
        *_common(),
        codec.topic_address(F.col("topic1")).alias("from_addr"),
        codec.topic_address(F.col("topic2")).alias("to_addr"),
        *_amount(codec.data_word(F.col("data"), 0), "amount"),
        codec.uint_overflows(codec.data_word(F.col("data"), 0)).alias("amount_overflow"),
    )


def referrals(
    logs: DataFrame, topic0s: Sequence[str] = (codec.REFERRAL_TOPIC, codec.STAKE_REFERRAL_TOPIC)
) -> DataFrame:
    """Referral events (both layouts put the code in topic1, the owner in topic2)."""
    return logs.filter(F.col("topic0").isin(*topic0s)).select(
        *_common(),
        codec.topic_address(F.col("topic2")).alias("owner"),
        codec.referral_code(F.col("topic1")).alias("ref_code"),
    )


def swaps(logs: DataFrame, topic0: str = codec.SWAP_TOPIC) -> DataFrame:
    """Swap events; the code is the last data word, the amount the one before."""
    amount_word = F.greatest(codec.word_count(F.col("data")) - 2, F.lit(0))
    amount = F.substring(codec.hex_body(F.col("data")), amount_word * codec.WORD + 1, F.lit(codec.WORD))
    return logs.filter(F.col("topic0") == topic0).select(
        *_common(),
        codec.topic_address(F.col("topic1")).alias("asset_in"),
        codec.topic_address(F.col("topic2")).alias("asset_out"),
        codec.topic_address(F.col("topic3")).alias("receiver"),
        *_amount(amount, "amount_out"),
        codec.swap_code(F.col("data")).alias("ref_code"),
    )


def stakes(logs: DataFrame) -> DataFrame:
    """Staked and Withdrawn events with a sign."""
    return logs.filter(F.col("topic0").isin(codec.STAKED_TOPIC, codec.WITHDRAWN_TOPIC)).select(
        *_common(),
        codec.topic_address(F.col("topic1")).alias("user_addr"),
        *_amount(codec.data_word(F.col("data"), 0), "amount"),
        F.when(F.col("topic0") == codec.STAKED_TOPIC, F.lit(1)).otherwise(F.lit(-1)).alias("sign"),
    )


def vault_flows(logs: DataFrame) -> DataFrame:
    """Deposit and Withdraw events: assets in word 0, shares in word 1."""
    return logs.filter(F.col("topic0").isin(codec.DEPOSIT_TOPIC, codec.WITHDRAW_TOPIC)).select(
        *_common(),
        *_amount(codec.data_word(F.col("data"), 0), "assets"),
        *_amount(codec.data_word(F.col("data"), 1), "shares"),
    )


def undecodable(transfers_df: DataFrame) -> DataFrame:
    """Transfers whose value does not fit the exact decimal; their amount is in ``amount_wide``."""
    return transfers_df.filter("amount_overflow")


def read_captures(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """Captured logs stored as JSON arrays, plain or gzip.

    ``whole_file`` reads one array per file, as captures are written by hand;
    large captures hold one array (or object) per line, which can be split.
    """
    return spark.read.schema(LOG_SCHEMA).option("multiLine", whole_file).json(path)
