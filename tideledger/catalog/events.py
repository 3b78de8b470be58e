"""Logs, legs and attribution."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tideledger.catalog.base import (
    ATTRIBUTION, EV, FULL_LEGS, NET, PLAIN_LEGS, REAL, RF, SIDES, ST, SW, TARGETS, TR, VF, ZERO, Ctx, day,
    query, with_,
)
from tideledger.functions import codec
from tideledger.operators import attribution as at, legs as lg
from tideledger.operators.twa import DUST
from tideledger.sources import driver_tables as dt, logs as lo
from tideledger.sources.registry import REROUTED_CODES, DeliveryProgram, programs_frame


def _id(c: str) -> str:
    return f"CASE WHEN {c} = '{ZERO}' THEN {c} ELSE '0x' || lpad(lower(hex({c})), 40, '0') END"


def _topic(c: str) -> str:
    return f"'0x' || lpad(substr({_id(c)}, 3), 64, '0')"


@query("s1_select_logs", with_(EV, TR, SW) + """
SELECT block_number, log_index, tx_hash FROM tr WHERE contract_address = 'tok0' AND block_number >= 10
UNION ALL
SELECT block_number, log_index, tx_hash FROM sw WHERE asset_out = 'tok1' AND block_number >= 10""")
def s1(c: Ctx):
    tok0, tok1 = dt.hex_address("tok0"), dt.hex_address("tok1")
    wanted = [
        {"address": [tok0], "topics": [[codec.TRANSFER_TOPIC]]},
        {"address": [tok0, tok1], "topics": [[codec.SWAP_TOPIC], [], ["0x" + tok1[2:].rjust(64, "0")]]},
    ]
    return lo.select_logs(c.logs, wanted, 10).select(
        "block_number", "log_index", F.col("transaction_hash").alias("tx_hash"))


@query("s2_decode_transfers", with_(EV, TR) + f"""
SELECT tx_hash, block_number, log_index, block_time, {_id('contract_address')} AS contract_address, {_id('from_addr')} AS from_addr,
  {_id('to_addr')} AS to_addr, amount, false AS amount_overflow FROM tr""")
def s2a(c: Ctx):
    return lo.transfers(c.logs).drop("blockchain", "amount_wide").withColumn("amount", F.col("amount").cast("bigint"))


@query("s2_decode_swaps", with_(EV, SW) + f"""
SELECT tx_hash, log_index, {_id('asset_out')} AS asset_out, {_id('receiver')} AS receiver, amount_out, ref_code FROM sw""")
def s2b(c: Ctx):
    return lo.swaps(c.logs).select("tx_hash", "log_index", "asset_out", "receiver", F.col("amount_out").cast("bigint").alias("amount_out"), "ref_code")


@query("s2_decode_referrals", with_(EV, RF) + f"SELECT tx_hash, log_index, {_id('owner')} AS owner, ref_code FROM rf")
def s2c(c: Ctx):
    return lo.referrals(c.logs).select("tx_hash", "log_index", "owner", "ref_code")


@query("s2_decode_stakes", with_(EV, ST) + f"SELECT tx_hash, {_id('user_addr')} AS user_addr, amount, sign FROM st")
def s2d(c: Ctx):
    return lo.stakes(c.logs).select("tx_hash", "user_addr", F.col("amount").cast("bigint").alias("amount"), "sign")


@query("s2_decode_vault_flows", with_(EV, VF) + "SELECT tx_hash, assets, shares FROM vf")
def s2e(c: Ctx):
    return lo.vault_flows(c.logs).select("tx_hash", F.col("assets").cast("bigint").alias("assets"), F.col("shares").cast("bigint").alias("shares"))


@query("s3_attach_block_time", with_(EV, TR) + "SELECT tx_hash, log_index, block_time FROM tr")
def s3(c: Ctx):
    return lo.attach_block_time(c.tr.drop("block_time"), dt.blocks(c.ev)).select("tx_hash", "log_index", "block_time")


@query("s4_block_at_or_before", with_(EV) + """
SELECT 'main' AS blockchain, coalesce(max(block_number), 0) AS block_number FROM ev WHERE block_time <= 1705276800
UNION ALL SELECT 'later', 0""")
def s4(c: Ctx):
    chains = c.spark.sql("select * from values ('main'), ('later') as t(blockchain)")
    return lo.block_at_or_before(dt.blocks(c.ev), 1705276800, chains)


@query("s5_inline_registries", with_(EV, TR, TARGETS) + """
SELECT symbol, count(*) AS transfers FROM tr JOIN targets USING (blockchain, contract_address) GROUP BY 1""")
def s5(c: Ctx):
    return c.tr.join(c.targets, ["blockchain", "contract_address"]).groupBy("symbol").agg(F.count("*").alias("transfers"))


@query("s6_dedupe_logs", with_(EV, TR) + "SELECT block_number, log_index, tx_hash FROM tr")
def s6(c: Ctx):
    moves = c.logs.filter(F.col("topic0") == codec.TRANSFER_TOPIC)
    return lo.dedupe_logs(moves.unionByName(moves.filter(F.col("topic1") == F.col("topic1")))).select(
        "block_number", "log_index", F.col("transaction_hash").alias("tx_hash"))


# --- predicates ---------------------------------------------------------------

@query("p1_scan_window", with_(EV, TR) + f"""
SELECT tx_hash, log_index FROM tr WHERE {day('block_time')} >= DATE '2024-01-05' AND block_time < 1706140800""")
def p1(c: Ctx):
    return c.tr.filter(lg.in_window(F.col("block_time"), F.lit(date(2024, 1, 5)), lg.end_second(date(2024, 1, 25)))).select("tx_hash", "log_index")


@query("p2_zero_address_never_user", with_(EV, TR, SIDES) + "SELECT user_addr, count(*) AS sides, CAST(sum(delta) AS BIGINT) AS net FROM sides GROUP BY 1")
def p2(c: Ctx):
    return at.wallet_sides(c.tr).groupBy("user_addr").agg(F.count("*").alias("sides"), F.sum("delta").alias("net"))


@query("p3_valid_codes", with_(EV, SW) + "SELECT ref_code, count(*) AS swaps FROM sw WHERE ref_code < 1000000000 GROUP BY 1")
def p3(c: Ctx):
    return c.sw.filter(F.col("ref_code") < 1000000000).groupBy("ref_code").agg(F.count("*").alias("swaps"))


@query("p4_drop_holders", with_(PLAIN_LEGS) + "SELECT user_addr, count(*) AS legs FROM legs WHERE user_addr NOT IN ('u3', 'u7') GROUP BY 1")
def p4(c: Ctx):
    return lg.drop_holders(c.plain_legs, dt.EXCLUDED).groupBy("user_addr").agg(F.count("*").alias("legs"))


@query("p6_no_self_transfers", with_(EV, TR) + "SELECT tx_hash, log_index FROM tr WHERE from_addr <> to_addr")
def p6(c: Ctx):
    return c.tr.filter(F.col("from_addr") != F.col("to_addr")).select("tx_hash", "log_index")


@query("p7_dust_floor", with_(EV, TR, SIDES) + """
SELECT contract_address, user_addr, CAST(sum(delta) AS BIGINT) AS balance FROM sides GROUP BY ALL HAVING sum(delta) > 1e-9""")
def p7(c: Ctx):
    return at.wallet_sides(c.tr).groupBy("contract_address", "user_addr").agg(F.sum("delta").alias("balance")).filter(F.col("balance") > DUST)


@query("p8_output_asset", with_(EV, SW) + "SELECT tx_hash, receiver FROM sw WHERE asset_out IN ('tok0', 'tok1')")
def p8(c: Ctx):
    tracked = c.targets.select("blockchain", F.col("contract_address").alias("asset_out"))
    return c.sw.join(tracked, ["blockchain", "asset_out"], "left_semi").select("tx_hash", "receiver")


def _windowed(spark):
    return programs_frame(spark, (DeliveryProgram("w", 1003, ("prog",), date(2024, 1, 8), date(2024, 1, 20)),))


@query("p10_program_window", with_(EV, TR, SIDES, NET) + f"""
SELECT t.tx_hash, t.to_addr AS user_addr, CAST(1003 AS BIGINT) AS ref_code FROM tr t
JOIN net n ON n.tx_hash = t.tx_hash AND n.contract_address = t.contract_address AND n.user_addr = t.to_addr
WHERE t.from_addr = 'prog' AND n.net > 0 AND {day('t.block_time')} >= DATE '2024-01-08' AND {day('t.block_time')} < DATE '2024-01-20'""")
def p10(c: Ctx):
    return at.delivery_codes(c.tr, _windowed(c.spark)).select("tx_hash", "user_addr", "ref_code")


# --- legs and attribution -----------------------------------------------------

_LEG_OUT = "user_addr, contract_address, symbol, block, log_index, leg_seq, ts, CAST(amount_change AS DOUBLE) AS amount_change, ref_code"


def _leg_cols(df):
    return df.select("user_addr", "contract_address", "symbol", "block", "log_index", "leg_seq", "ts", "amount_change", "ref_code")


@query("d1_transfer_legs", with_(PLAIN_LEGS) + f"SELECT {_LEG_OUT} FROM legs")
def d1(c: Ctx):
    return _leg_cols(c.plain_legs)


@query("d1_transaction_legs", with_(FULL_LEGS) + """
SELECT contract_address, symbol, user_addr, block, max(log_index) AS log_index, max(ts) AS ts,
  CAST(sum(amount_change) AS DOUBLE) AS amount_change, max(ref_code) AS ref_code
FROM (SELECT l.*, s.tx_hash FROM legs l JOIN (SELECT DISTINCT block_number, log_index, tx_hash FROM tr) s
      ON s.block_number = l.block AND s.log_index = l.log_index) GROUP BY contract_address, symbol, user_addr, block, tx_hash""")
def d1b(c: Ctx):
    return c.legs.select("contract_address", "symbol", "user_addr", "block", "log_index", "ts", "amount_change", "ref_code")


@query("d1_null_hash_legs", with_(EV, TR, RF, TARGETS, REAL, f"""named AS (
  SELECT *, CASE WHEN CAST(substr(tx_hash, 3) AS BIGINT) % 7 = 3 THEN '#:' || block_number || ':' || log_index ELSE tx_hash END AS tx FROM tr),
parts AS (
  SELECT contract_address, tx, tx_hash, block_number, log_index, block_time, to_addr AS user_addr, amount AS delta,
    from_addr = 'prog' AND to_addr <> 'prog' AND tx = tx_hash AS delivered FROM named WHERE to_addr <> '{ZERO}'
  UNION ALL SELECT contract_address, tx, tx_hash, block_number, log_index, block_time, from_addr, -amount, false FROM named WHERE from_addr <> '{ZERO}')""") + """
SELECT p.contract_address, symbol, p.user_addr, max(block_number) AS block, max(p.log_index) AS log_index, max(block_time) AS ts,
  CAST(sum(delta) AS DOUBLE) AS amount_change, coalesce(max(c.ref_code), CASE WHEN bool_or(delivered) AND sum(delta) > 0 THEN 1003 END) AS ref_code
FROM parts p JOIN targets USING (blockchain, contract_address)
LEFT JOIN real_codes c ON c.tx_hash = p.tx AND c.contract_address = p.contract_address AND c.user_addr = p.user_addr
GROUP BY p.contract_address, symbol, p.user_addr, p.tx""".replace("USING (blockchain, contract_address)", "t ON t.contract_address = p.contract_address"))
def d1_null_hash(c: Ctx):
    # Every seventh event's logs come without a transaction hash: each is a transaction of its own, without code or delivery.
    lost = c.tr.withColumn("tx_hash", F.when(F.col("event_id") % 7 != 3, F.col("tx_hash")))
    legs = lg.transaction_legs(lost, [at.real_codes(c.rf)], c.targets, programs=c.programs)
    return legs.select("contract_address", "symbol", "user_addr", "block", "log_index", "ts", "amount_change", "ref_code")


@query("d2_referral_map", with_(EV, RF, REAL) + "SELECT contract_address, tx_hash, user_addr, log_index, ref_code FROM real_codes")
def d2(c: Ctx):
    return at.real_codes(c.rf).select("contract_address", "tx_hash", "user_addr", "log_index", "ref_code")


@query("d3_swap_referral_map", with_(EV, SW) + """
SELECT asset_out AS contract_address, tx_hash, receiver AS user_addr, max(log_index) AS log_index, arg_max(ref_code, log_index) AS ref_code
FROM sw WHERE asset_out IN ('tok0', 'tok1') AND ref_code < 1000000000 GROUP BY ALL""")
def d3(c: Ctx):
    pairs = c.targets.select("blockchain", "contract_address", F.col("contract_address").alias("swap_contract"))
    return at.swap_codes(c.sw, pairs).select("contract_address", "tx_hash", "user_addr", "log_index", "ref_code")


@query("d4_stake_legs", with_(EV, RF, ST, REAL, TARGETS) + """
SELECT s.user_addr, s.contract_address, t.symbol, s.block_number AS block, s.log_index, 0 AS leg_seq, s.block_time AS ts,
  CAST(s.sign * s.amount AS DOUBLE) AS amount_change, c.ref_code
FROM st s JOIN targets t USING (blockchain, contract_address)
LEFT JOIN real_codes c ON c.tx_hash = s.tx_hash AND c.user_addr = s.user_addr AND c.contract_address = s.contract_address""")
def d4(c: Ctx):
    return _leg_cols(lg.stake_legs(c.st, at.real_codes(c.rf), c.targets))


HOLDERS_SQL = """holders AS (SELECT * FROM (VALUES ('tok0', 'sUSDS', 'u2', 9001), ('tok1', 'sUSDC', 'u1', 4001), ('tok0', 'sUSDS', 'prog', 7001))
  AS t(contract_address, symbol, holder, code)),
holder_legs AS (
  SELECT 'main' AS blockchain, h.contract_address, h.symbol, h.holder AS user_addr, t.block_number AS block, t.log_index, 0 AS leg_seq,
    t.block_time AS ts, CASE WHEN t.to_addr = h.holder THEN amount ELSE -amount END AS amount_change, CAST(h.code AS BIGINT) AS ref_code
  FROM tr t JOIN holders h ON h.contract_address = t.contract_address AND (t.to_addr = h.holder) <> (t.from_addr = h.holder) AND amount <> 0)"""


def holders(c: Ctx):
    return c.spark.sql("""select * from values ('main','tok0','sUSDS',0,'u2',9001L), ('main','tok1','sUSDC',0,'u1',4001L),
        ('main','tok0','sUSDS',0,'prog',7001L) as t(blockchain, contract_address, symbol, decimals, holder, holder_code)""")


@query("d5_holder_legs", with_(EV, TR, HOLDERS_SQL) + f"SELECT {_LEG_OUT} FROM holder_legs")
def d5(c: Ctx):
    return _leg_cols(lg.holder_legs(c.tr, holders(c)))


@query("d6_delivery_codes", with_(ATTRIBUTION) + "SELECT contract_address, tx_hash, user_addr, log_index, ref_code, kind FROM delivery")
def d6(c: Ctx):
    return at.delivery_codes(c.tr, c.programs).drop("blockchain")


@query("d7_untagged_mint_recipients", with_(EV, TR, f"""extra AS (
  SELECT 'main' AS blockchain, token AS contract_address, tx_hash, block_number, first_index + 3 AS log_index, block_time,
    '{ZERO}' AS from_addr, 'm' || (event_id % 7) AS to_addr, cents AS amount FROM ev WHERE event_type = 'purchase')""") + f"""
SELECT contract_address, tx_hash, to_addr AS user_addr, amount AS net FROM extra x WHERE amount > 5000""")
def d7(c: Ctx):
    # Every delivery transaction also mints straight to a side wallet.
    minted = c.ev.filter("event_type = 'purchase'").select(
        F.lit(dt.CHAIN).alias("blockchain"), F.col("token").alias("contract_address"), "event_id", "tx_hash", "block_number",
        (F.col("first_index") + 3).alias("log_index"), "block_time", F.lit(ZERO).alias("from_addr"),
        F.concat(F.lit("m"), F.col("event_id") % 7).alias("to_addr"), F.col("cents").alias("amount"))
    return at.untagged_mint_recipients(c.tr.unionByName(minted), c.programs, 5000).drop("blockchain")


@query("d8_rerouted_codes", with_(ATTRIBUTION) + "SELECT contract_address, tx_hash, user_addr, log_index, ref_code, kind FROM rerouted")
def d8(c: Ctx):
    return at.rerouted_codes(c.rf, c.tr, REROUTED_CODES).drop("blockchain")


@query("d9_merged_codes", with_(ATTRIBUTION) + "SELECT contract_address, tx_hash, user_addr, log_index, ref_code, kind FROM merged")
def d9(c: Ctx):
    return at.merge_codes(*c.code_maps).drop("blockchain")


# --- single-code wallet sets --------------------------------------------------

MOVES = "moves AS (SELECT * FROM sides WHERE from_addr <> to_addr)"
CODE_NET = """code_net AS (
  SELECT contract_address, tx_hash, user_addr, CAST(sum(delta) AS BIGINT) AS net FROM moves
  WHERE (contract_address, tx_hash) IN (SELECT contract_address, tx_hash FROM rf WHERE ref_code = 1004)
  GROUP BY ALL HAVING sum(delta) > 0.0001)"""
_BASE41 = [EV, TR, RF, SIDES, MOVES, CODE_NET]


@query("d41_wallets_net_recipients", with_(*_BASE41) + "SELECT DISTINCT contract_address, user_addr FROM code_net WHERE user_addr <> 'router'")
def d41a(c: Ctx):
    return at.wallet_set("net_recipients", c.rf, c.tr, 1004, routers=["router"]).drop("blockchain")


@query("d41_wallets_owners", with_(EV, RF) + "SELECT DISTINCT contract_address, owner AS user_addr FROM rf WHERE ref_code = 1004")
def d41b(c: Ctx):
    return at.wallet_set("owners", c.rf, c.tr, 1004).drop("blockchain")


@query("d41_wallets_non_contracts", with_(*_BASE41) + """
SELECT DISTINCT contract_address, user_addr FROM code_net WHERE user_addr NOT IN (SELECT 'u' || s_suppkey FROM supplier)""")
def d41c(c: Ctx):
    contracts = c.table("supplier").select(F.concat(F.lit("u"), F.col("s_suppkey")).alias("user_addr"))
    return at.wallet_set("non_contracts", c.rf, c.tr, 1004, contracts=contracts).drop("blockchain")


@query("d41_wallets_owners_recipients", with_(EV, TR, RF) + f"""
SELECT DISTINCT contract_address, user_addr FROM (
  SELECT contract_address, owner AS user_addr FROM rf WHERE ref_code = 4011
  UNION ALL SELECT contract_address, to_addr FROM tr WHERE to_addr <> '{ZERO}' AND to_addr <> from_addr
    AND (contract_address, tx_hash) IN (SELECT contract_address, tx_hash FROM rf WHERE ref_code = 4011))""")
def d41d(c: Ctx):
    return at.wallet_set("owners_recipients", c.rf, c.tr, 4011).drop("blockchain")


STUDIED = """wallets AS (SELECT DISTINCT contract_address, user_addr FROM code_net WHERE user_addr <> 'router'),
studied AS (
  SELECT m.blockchain, m.contract_address, m.user_addr, m.block_number AS block, m.log_index, m.leg_seq, m.block_time AS ts,
    m.delta AS amount_change, coalesce(own.code, any_owner.code,
      CASE WHEN m.leg_seq = 0 AND m.tx_hash IN (SELECT tx_hash FROM tr WHERE from_addr = 'prog') THEN 1003 END) AS ref_code
  FROM moves m JOIN wallets w USING (contract_address, user_addr)
  LEFT JOIN (SELECT tx_hash, contract_address, owner, arg_max(ref_code, log_index) AS code FROM rf GROUP BY ALL) own
    ON own.tx_hash = m.tx_hash AND own.contract_address = m.contract_address AND own.owner = m.user_addr
  LEFT JOIN (SELECT tx_hash, contract_address, arg_max(ref_code, log_index) AS code FROM rf GROUP BY ALL) any_owner
    ON any_owner.tx_hash = m.tx_hash AND any_owner.contract_address = m.contract_address)"""


def studied(c: Ctx):
    wallets = at.wallet_set("net_recipients", c.rf, c.tr, 1004, routers=["router"])
    trades = c.tr.filter(F.col("from_addr") == "prog")
    return at.studied_legs(c.rf, c.tr, wallets, trades, 1003)


@query("d41_studied_legs", with_(*_BASE41, STUDIED) + "SELECT contract_address, user_addr, block, log_index, leg_seq, ts, amount_change, ref_code FROM studied")
def d41e(c: Ctx):
    return studied(c).drop("blockchain", "tx_hash")


@query("d42_routed_transactions", with_(EV, TR, RF, SIDES, MOVES) + """
SELECT r.tx_hash, r.block_number, r.owner, n.user_addr AS net_recipient, n.net,
  CASE WHEN n.user_addr = r.owner THEN 'direct' ELSE 'routed' END AS flow_type
FROM rf r JOIN (SELECT contract_address, tx_hash, user_addr, CAST(sum(delta) AS BIGINT) AS net FROM moves GROUP BY ALL) n USING (contract_address, tx_hash)
WHERE r.ref_code = 4011 AND abs(n.net) > 0.0001""")
def d42(c: Ctx):
    return at.routed_transactions(c.rf, c.tr, 4011).select("tx_hash", "block_number", "owner", "net_recipient", "net", "flow_type")
