"""Codes, labels and numbers as they appear in reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The untagged sentinel and codes that have no beneficiary.
UNTAGGED = -999999
NON_PAYABLE_CODES = (-999999, 99, 127, 10000, 10001)

# Codes whose rollup line is split by token.
SPLIT_BY_TOKEN_CODES = (0, 1)

# Code ranges per partner group; first match wins. Labels are
# data of the caller, so the defaults only name the range.
GROUP_RULES: tuple[tuple[str, tuple[tuple[int, int], ...]], ...] = (
    ("other", ((99, 99), (126, 126), (10000, 10001))),
    ("base_and_1000s", ((0, 1), (1000, 1999))),
    ("below_1000", ((2, 999), (9001, 9001))),
    ("2000s", ((2000, 2999),)),
    ("3000s", ((3000, 3999),)),
    ("4000s", ((4000, 4999),)),
)
OTHER_GROUP = "other"

# Display relabelling of tokens.
STAKED_TOKENS = ("USDS-SPK", "USDS-SKY")
TREASURY_TOKEN = "USDS"


def comma_number(text: Column) -> Column:
    """``1,160.2`` to 1160.2; unparsable text to null."""
    return F.regexp_replace(F.trim(text), ",", "").try_cast("double")


def plain_code(text: Column) -> Column:
    """Expand a code in scientific notation to its integer digits."""
    expanded = text.try_cast("double").cast("decimal(38,0)").cast("string")
    return F.when(text.rlike("[eE]"), expanded).otherwise(text)


def leading_int(text: Column) -> Column:
    """Leading integer of a plain or compound code, else null."""
    return F.regexp_extract(text, r"^(-?\d+)", 1).try_cast("bigint")


def compound_label(code: Column, token: Column) -> Column:
    """``code (token)`` for codes shown per token, else the code."""
    split = F.concat(code.cast("string"), F.lit(" ("), token, F.lit(")"))
    return F.when(code.isin(*SPLIT_BY_TOKEN_CODES), split).otherwise(code.cast("string"))


def user_shard(user: Column, shards: int) -> Column:
    """Shard of an address from its first eight hex digits."""
    return F.conv(F.substring(user, 3, 8), 16, 10).cast("bigint") % F.lit(shards)


def partner_group(code: Column, labels: Mapping[str, str] | None = None) -> Column:
    """Partner group of a plain or compound code."""
    names = labels or {}
    n = leading_int(code.cast("string"))
    out = None
    for name, ranges in GROUP_RULES:
        hit = None
        for low, high in ranges:
            one = n.between(low, high)
            hit = one if hit is None else (hit | one)
        label = F.lit(names.get(name, name))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(F.lit(names.get(OTHER_GROUP, OTHER_GROUP)))


def referral_type(
    token: Column, code: Column, own: str = "own referrals", partner: str = "partner referrals"
) -> Column:
    """Whose referral a (token, code) pair counts as."""
    always_own = token.isin("sUSDC", "spUSDC", "spUSDT", "spPYUSD")
    return (
        F.when(always_own, F.lit(own))
        .when(token == "spETH", F.lit(partner))
        .when(code.between(100, 999), F.lit(own))
        .otherwise(F.lit(partner))
    )


def display_symbol(token: Column) -> Column:
    """Token symbol used to look up prices."""
    return (
        F.when(token.isin(*STAKED_TOKENS), F.lit("stakedUSDS"))
        .when(token == TREASURY_TOKEN, F.lit("USDS - Treasury"))
        .otherwise(token)
    )


def display_token(token: Column) -> Column:
    return F.when(token == TREASURY_TOKEN, F.lit("USDS - Treasury")).otherwise(token)


def with_notes(df: DataFrame, notes: DataFrame, code: str = "ref_code") -> DataFrame:
    """Attach the note of each code (blank when there is none)."""
    looked_up = notes.select(F.col("ref_code").alias(code), F.col("note").alias("notes"))
    return df.join(looked_up, code, "left").withColumn("notes", F.coalesce("notes", F.lit("")))


def code_order(code: Column) -> Sequence[Column]:
    """Sort keys: numeric codes ascending, then labels."""
    return [leading_int(code).asc_nulls_last(), code.asc()]
