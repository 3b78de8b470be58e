"""Hand-built event rows."""

from __future__ import annotations

DAY = 1735689600  # 2025-01-01 00:00 UTC
ZERO = "0x" + "0" * 40
CHAIN, TOKEN = "main", "tok"
UNIT = 10**18

TRANSFER_SCHEMA = ("blockchain string, contract_address string, tx_hash string, block_number bigint, log_index bigint, "
                   "block_time bigint, from_addr string, to_addr string, amount decimal(38,0)")
REFERRAL_SCHEMA = ("blockchain string, contract_address string, tx_hash string, block_number bigint, log_index bigint, "
                   "block_time bigint, owner string, ref_code bigint")
LEG_SCHEMA = ("blockchain string, contract_address string, symbol string, user_addr string, block bigint, log_index bigint, "
              "leg_seq int, ts bigint, amount_change double, ref_code bigint")


def tr(tx, li, frm, to, amount, block=100, ts=DAY, raw=False):
    from decimal import Decimal

    units = amount if raw else int(amount * UNIT)
    return (CHAIN, TOKEN, tx, block, li, ts, frm, to, Decimal(units))


def ref(tx, li, owner, code, block=100, ts=DAY):
    return (CHAIN, TOKEN, tx, block, li, ts, owner, code)


def transfers(spark, rows):
    return spark.createDataFrame(rows, TRANSFER_SCHEMA)


def referrals(spark, rows):
    return spark.createDataFrame(rows, REFERRAL_SCHEMA)


def targets(spark, decimals=18):
    return spark.sql(f"select '{CHAIN}' blockchain, '{TOKEN}' contract_address, 'sUSDS' symbol, {decimals} decimals, date'2024-09-01' start_date")


def tags(df):
    return {(r["tx_hash"], r["user_addr"]): (r["log_index"], r["ref_code"]) for r in df.collect()}


def word(n: int) -> str:
    return format(n, "064x")


def topic(address: str) -> str:
    return "0x" + address[2:].rjust(64, "0")
