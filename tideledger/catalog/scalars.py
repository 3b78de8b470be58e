"""Column functions over the given tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tideledger.catalog.base import EV, ZERO, Ctx, day, query, with_
from tideledger.functions import codec, dates, labels, rates, wide
from tideledger.sources import driver_tables as dt


def _hex_id_sql(c: str) -> str:
    return f"CASE WHEN {c} = '{ZERO}' THEN {c} ELSE '0x' || lpad(lower(hex({c})), 40, '0') END"


@query("f1_topic_address", with_(EV) + f"""
SELECT tx_hash, first_index AS log_index, {_hex_id_sql('u')} AS from_addr, '{ZERO}' AS to_addr FROM ev WHERE event_type = 'error'
UNION ALL
SELECT tx_hash, first_index, {_hex_id_sql('u')}, {_hex_id_sql('cp')} FROM ev WHERE event_type = 'click'""")
def f1(c: Ctx):
    moves = c.logs.filter(F.col("topic0") == codec.TRANSFER_TOPIC)
    kinds = c.ev.filter(F.col("event_type").isin("error", "click")).select(F.col("tx_hash").alias("transaction_hash"))
    return moves.join(kinds, "transaction_hash", "left_semi").select(
        F.col("transaction_hash").alias("tx_hash"), "log_index",
        codec.topic_address(F.col("topic1")).alias("from_addr"), codec.topic_address(F.col("topic2")).alias("to_addr"))


@query("f2_address_topic", "SELECT c_custkey, '0x' || lpad(lower(to_hex(c_custkey)), 64, '0') AS topic FROM customer")
def f2(c: Ctx):
    address = F.concat(F.lit("0x"), F.lpad(F.upper(F.hex("c_custkey")), 12, "0"))
    return c.table("customer").select("c_custkey", codec.address_topic(address).alias("topic"))


@query("f3_data_word", with_(EV) + """
SELECT tx_hash, lpad(lower(to_hex(cents)), 64, '0') AS word1, 3 AS words FROM ev WHERE event_type = 'signup'""")
def f3(c: Ctx):
    return c.logs.filter(F.col("topic0") == codec.SWAP_TOPIC).select(
        F.col("transaction_hash").alias("tx_hash"), codec.data_word(F.col("data"), 1).alias("word1"),
        codec.word_count(F.col("data")).alias("words"))


@query("f4_uint", """
SELECT o_orderkey, CAST(o_orderkey::HUGEINT * 1152921504606846976::HUGEINT + o_custkey AS VARCHAR) AS value,
  false AS too_wide FROM orders
UNION ALL
SELECT -1 - o_orderkey, NULL, true FROM orders""")
def f4(c: Ctx):
    o = c.table("orders")
    low = F.lpad(F.hex("o_custkey"), 15, "0")
    fits = o.select("o_orderkey", F.lpad(F.concat(F.hex("o_orderkey"), low), 64, "0").alias("word"))
    wide = o.select((F.lit(-1) - F.col("o_orderkey")).alias("o_orderkey"),
                    F.lpad(F.concat(F.lit("1"), F.lpad(F.hex("o_orderkey"), 30, "0")), 64, "0").alias("word"))
    return fits.unionByName(wide).select(
        "o_orderkey", codec.uint(F.col("word")).cast("string").alias("value"),
        codec.uint_overflows(F.col("word")).alias("too_wide"))


_HIGH, _LOW = "CAST(o_orderkey AS HUGEINT) * 1000003 + 7", "CAST(o_custkey AS HUGEINT) * 1125899906842624 + o_orderkey"


@query("f4_wide_words", f"""
WITH parts AS (SELECT o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END AS sign, {_HIGH} AS high, {_LOW} AS low FROM orders),
sums AS (SELECT o_custkey, sum(sign * high) AS high, sum(sign * low) AS low, count(*) AS n FROM parts GROUP BY 1),
normal AS (SELECT o_custkey, n, high + (low - ((low % m + m) % m)) // m AS high, (low % m + m) % m AS low FROM sums, (SELECT CAST(1 AS HUGEINT) << 100 AS m))
SELECT o_custkey, n, CAST(high AS VARCHAR) AS high, CAST(low AS VARCHAR) AS low FROM normal""")
def f4_wide(c: Ctx):
    # Words high * 2^150 + low, signed, summed per customer; both halves of the exact sum come back from its digits in base 2.
    o = c.table("orders")
    high = F.lower(F.hex((F.col("o_orderkey") * 1000003 + 7).cast("bigint")))
    # custkey * 2^50 + orderkey passes 64 bits from custkey 8192 on, so its digits come in two pieces: the last 48 bits and those above.
    above = F.hex(F.col("o_custkey") * 4 + F.shiftright("o_orderkey", 48))
    low = F.lower(F.concat(above, F.lpad(F.hex(F.col("o_orderkey").bitwiseAND(F.lit((1 << 48) - 1))), 12, "0")))
    word = F.lpad(F.concat(high, F.lpad(low, 25, "0")), 64, "0")  # 25 hex digits: 100 bits
    signed = F.when(F.col("o_orderkey") % 3 == 0, wide.times(wide.limbs(word), -1)).otherwise(wide.limbs(word))
    sums = o.select("o_custkey", signed.alias("v")).groupBy("o_custkey").agg(wide.total(F.col("v")).alias("v"), F.count("*").alias("n"))
    exact = sums.select("o_custkey", "n", wide.carried(F.col("v")).alias("v"))
    # lo and mid hold 96 bits each: four bits of mid belong to the low half.
    sixteen = F.lit(16).cast("decimal(38,0)")
    rest = F.pmod(F.col("v.mid"), sixteen).cast("decimal(38,0)")
    above = ((F.col("v.mid") - rest) / sixteen).cast("decimal(38,0)")
    base, step = F.lit(Decimal(1 << 96)).cast("decimal(38,0)"), F.lit(Decimal(1 << 92)).cast("decimal(38,0)")
    return exact.select("o_custkey", "n", (F.col("v.hi") * step + above).cast("decimal(38,0)").cast("string").alias("high"),
                        (rest * base + F.col("v.lo")).cast("decimal(38,0)").cast("string").alias("low"))


@query("f5_referral_code", with_(EV) + """
SELECT tx_hash, CASE WHEN event_type = 'signup' THEN k WHEN k % 2 = 0 THEN 1004 ELSE 4011 END AS ref_code
FROM ev WHERE event_type IN ('signup', 'view')""")
def f5(c: Ctx):
    return c.logs.filter(F.col("topic0") == codec.REFERRAL_TOPIC).select(
        F.col("transaction_hash").alias("tx_hash"), codec.referral_code(F.col("topic1")).alias("ref_code"))


@query("f6_swap_code", with_(EV) + """
SELECT tx_hash, CASE WHEN k % 10 = 9 THEN k + 1000000000 ELSE k END AS ref_code FROM ev WHERE event_type = 'signup'
UNION ALL SELECT tx_hash, 0 FROM ev WHERE event_type = 'view'""")
def f6(c: Ctx):
    swaps = c.logs.filter(F.col("topic0") == codec.SWAP_TOPIC).select("transaction_hash", "data")
    bare = c.ev.filter("event_type = 'view'").select(F.col("tx_hash").alias("transaction_hash"), F.lit("0x").alias("data"))
    return swaps.unionByName(bare).select(
        F.col("transaction_hash").alias("tx_hash"), codec.swap_code(F.col("data")).alias("ref_code"))


@query("f7_flexible_number", "SELECT o_orderkey, o_custkey AS n FROM orders")
def f7(c: Ctx):
    text = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("0x"), F.lower(F.hex("o_custkey")))).otherwise(
        F.col("o_custkey").cast("string"))
    return c.table("orders").select("o_orderkey", codec.flexible_number(text).alias("n"))


@query("f8_scaled", """
SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT)::DOUBLE / pow(10.0::DOUBLE, o_custkey % 7) AS amount FROM orders""")
def f8(c: Ctx):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return c.table("orders").select("o_orderkey", codec.scaled(cents, F.col("o_custkey") % 7).alias("amount"))


@query("f9_day_bounds", with_(EV) + f"""
SELECT event_id, {day('block_time')} AS dt, block_time // 86400 * 86400 AS day_start, block_time // 86400 * 86400 + 86400 AS day_end FROM ev""")
def f9(c: Ctx):
    d = dates.day_of(F.col("block_time"))
    return c.ev.select("event_id", d.alias("dt"), dates.midnight(d).alias("day_start"), dates.next_midnight(d).alias("day_end"))


@query("f10_seconds_between", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) - CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS seconds FROM events""")
def f10(c: Ctx):
    ts = F.col("ts").cast("timestamp")
    return c.table("events").select("event_id", dates.seconds_between(F.date_trunc("day", ts), ts).alias("seconds"))


@query("f11_month_bucket", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS orders FROM orders GROUP BY 1")
def f11(c: Ctx):
    return c.table("orders").groupBy(dates.month_start(F.to_date("o_orderdate")).alias("month")).agg(F.count("*").alias("orders"))


@query("f12_annualised_daily_rate", """
SELECT apy, round(CASE WHEN apy = 0 THEN 0 ELSE 365.0::DOUBLE * (exp(ln(1.0::DOUBLE + apy) / 365.0::DOUBLE) - 1.0::DOUBLE) END, 9) AS reward_per, n
FROM (SELECT l_discount AS apy, count(*) AS n FROM lineitem GROUP BY 1)""")
def f12(c: Ctx):
    apys = c.table("lineitem").groupBy(F.col("l_discount").alias("apy")).agg(F.count("*").alias("n"))
    return apys.select("apy", F.round(rates.annualised_daily_rate(F.col("apy")), 9).alias("reward_per"), "n")


@query("f13_conditionals", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag IN ('A', 'R') THEN 'back' WHEN l_quantity BETWEEN 10 AND 20 THEN 'mid' ELSE 'other' END AS label,
  coalesce(nullif(l_linenumber, 1), -1) AS second_line, least(l_quantity, 24.0) AS lo, greatest(l_discount, l_tax) AS hi,
  round(l_extendedprice * (1 - l_discount), 6) AS net, l_linestatus LIKE 'O%' AS is_open
FROM lineitem""")
def f13(c: Ctx):
    li = c.table("lineitem")
    label = F.when(F.col("l_returnflag").isin("A", "R"), "back").when(F.col("l_quantity").between(10, 20), "mid").otherwise("other")
    return li.select(
        "l_orderkey", "l_linenumber", label.alias("label"),
        F.coalesce(F.nullif(F.col("l_linenumber"), F.lit(1)), F.lit(-1)).alias("second_line"),
        F.least("l_quantity", F.lit(24.0)).alias("lo"), F.greatest("l_discount", "l_tax").alias("hi"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 6).alias("net"),
        F.col("l_linestatus").like("O%").alias("is_open"))


@query("f14_named_month", """
SELECT label, CAST(month AS DATE) AS month, count(*) AS n FROM (
  SELECT strftime(o_orderdate, '%b %Y') AS label, date_trunc('month', o_orderdate) AS month FROM orders
  UNION ALL SELECT o_orderpriority, NULL FROM orders) GROUP BY 1, 2""")
def f14(c: Ctx):
    o = c.table("orders")
    text = o.select(F.date_format("o_orderdate", "MMM yyyy").alias("label")).union(o.select("o_orderpriority"))
    return text.groupBy("label").agg(F.count("*").alias("n")).withColumn("month", dates.named_month(F.col("label")))


@query("f15_comma_number", "SELECT c_custkey, round(c_acctbal, 2) AS value FROM customer UNION ALL SELECT -c_custkey - 1, NULL FROM customer")
def f15(c: Ctx):
    t = c.table("customer")
    text = t.select("c_custkey", F.format_number("c_acctbal", 2).alias("text")).union(
        t.select(-F.col("c_custkey") - 1, F.col("c_mktsegment")))
    return text.select("c_custkey", labels.comma_number(F.col("text")).alias("value"))


@query("f16_plain_code", """
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CAST((p_partkey % 9 + 1)::HUGEINT * 10000000000000000000::HUGEINT AS VARCHAR)
  ELSE CAST(p_partkey AS VARCHAR) END AS code FROM part""")
def f16(c: Ctx):
    text = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.col("p_partkey") % 9 + 1, F.lit("E+19"))).otherwise(
        F.col("p_partkey").cast("string"))
    return c.table("part").select("p_partkey", labels.plain_code(text).alias("code"))


@query("f17_leading_int", """
SELECT o_orderpriority AS label, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS n, count(*) AS orders FROM orders GROUP BY 1
UNION ALL SELECT o_orderstatus, NULL, count(*) FROM orders GROUP BY 1""")
def f17(c: Ctx):
    o = c.table("orders")
    text = o.select(F.col("o_orderpriority").alias("label")).union(o.select("o_orderstatus"))
    return text.groupBy("label").agg(F.count("*").alias("orders")).withColumn("n", labels.leading_int(F.col("label")))


@query("f18_user_shard", "SELECT c_custkey * 2654435761 % 4294967296 % 8 AS shard, count(*) AS users FROM customer GROUP BY 1")
def f18(c: Ctx):
    spread = F.col("c_custkey") * F.lit(2654435761) % F.lit(4294967296)
    address = F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(spread)), 8, "0"), F.lpad(F.lower(F.hex("c_custkey")), 32, "0"))
    return c.table("customer").groupBy(labels.user_shard(address, 8).alias("shard")).agg(F.count("*").alias("users"))


@query("f19_settlement_calendar", """
SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(max(last_day(o_orderdate)) AS DATE) AS last_day,
  CAST(max(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH) AS DATE) AS end_exclusive FROM orders GROUP BY 1""")
def f19(c: Ctx):
    months = c.table("orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month")).distinct()
    return months.select("month", dates.settle_last_day(F.col("month")).alias("last_day"),
                         dates.settle_end_exclusive(F.col("month")).alias("end_exclusive"))


GROUP_SQL = """CASE WHEN {n} IN (99, 126, 10000, 10001) THEN 'other' WHEN {n} IN (0, 1) OR {n} BETWEEN 1000 AND 1999 THEN 'base_and_1000s'
  WHEN {n} BETWEEN 2 AND 999 OR {n} = 9001 THEN 'below_1000' WHEN {n} BETWEEN 2000 AND 2999 THEN '2000s'
  WHEN {n} BETWEEN 3000 AND 3999 THEN '3000s' WHEN {n} BETWEEN 4000 AND 4999 THEN '4000s' ELSE 'other' END"""


@query("f20_partner_group", f"SELECT o_orderkey, {GROUP_SQL.format(n='o_orderkey')} AS partner_group FROM orders")
def f20(c: Ctx):
    return c.table("orders").select("o_orderkey", labels.partner_group(F.col("o_orderkey")).alias("partner_group"))


_TOKENS = "['sUSDS','sUSDC','stUSDS','USDS-SKY','spUSDC','spUSDT','spPYUSD','spETH','USDS','USDS-SPK']"


def _token(key: str):
    names = dt.LEDGER_TOKENS + ("USDS", "USDS-SPK")
    return F.element_at(F.array(*[F.lit(t) for t in names]), (F.col(key) % 10 + 1).cast("int"))


@query("f21_referral_type", f"""
SELECT p_partkey, tk AS token, CASE WHEN tk IN ('sUSDC', 'spUSDC', 'spUSDT', 'spPYUSD') THEN 'own referrals' WHEN tk = 'spETH' THEN 'partner referrals'
  WHEN p_partkey BETWEEN 100 AND 999 THEN 'own referrals' ELSE 'partner referrals' END AS referral_type
FROM (SELECT p_partkey, {_TOKENS}[p_partkey % 10 + 1] AS tk FROM part)""")
def f21(c: Ctx):
    t = c.table("part").select("p_partkey", _token("p_partkey").alias("token"))
    return t.withColumn("referral_type", labels.referral_type(F.col("token"), F.col("p_partkey")))


@query("f22_display_token", f"""
SELECT p_partkey, CASE WHEN tk IN ('USDS-SPK', 'USDS-SKY') THEN 'stakedUSDS' WHEN tk = 'USDS' THEN 'USDS - Treasury' ELSE tk END AS token_symbol,
  CASE WHEN tk = 'USDS' THEN 'USDS - Treasury' ELSE tk END AS token FROM (SELECT p_partkey, {_TOKENS}[p_partkey % 10 + 1] AS tk FROM part)""")
def f22(c: Ctx):
    t = c.table("part").select("p_partkey", _token("p_partkey").alias("t"))
    return t.select("p_partkey", labels.display_symbol(F.col("t")).alias("token_symbol"), labels.display_token(F.col("t")).alias("token"))


@query("f23_note_lookup", with_(EV) + """
SELECT e.k AS ref_code, count(*) AS n, coalesce(max(n_name), '') AS notes FROM ev e LEFT JOIN nation ON n_nationkey = e.k GROUP BY 1""")
def f23(c: Ctx):
    notes = c.table("nation").select(F.col("n_nationkey").cast("bigint").alias("ref_code"), F.col("n_name").alias("note"))
    per_code = c.ev.groupBy(F.col("k").alias("ref_code")).agg(F.count("*").alias("n"))
    return labels.with_notes(per_code, notes)


@query("f24_per_second_rate", """
SELECT l_tax, round(pow((1e27::DOUBLE + l_tax * 1e18::DOUBLE) / 1e27::DOUBLE, 31536000) - 1, 6) AS apy FROM (SELECT DISTINCT l_tax FROM lineitem)""")
def f24(c: Ctx):
    ray = F.lit(1e27) + F.col("l_tax") * F.lit(1e18)
    return c.table("lineitem").select("l_tax").distinct().withColumn("apy", F.round(rates.per_second_to_apy(ray), 6))


@query("f25_compound_label", f"""
SELECT label, count(*) AS n FROM (SELECT CASE WHEN p_partkey % 5 IN (0, 1) THEN p_partkey % 5 || ' (' || tk || ')' ELSE CAST(p_partkey % 5 AS VARCHAR) END AS label
FROM (SELECT p_partkey, {_TOKENS}[p_partkey % 10 + 1] AS tk FROM part)) GROUP BY 1""")
def f25(c: Ctx):
    t = c.table("part").select((F.col("p_partkey") % 5).alias("code"), _token("p_partkey").alias("token"))
    return t.groupBy(labels.compound_label(F.col("code"), F.col("token")).alias("label")).agg(F.count("*").alias("n"))
