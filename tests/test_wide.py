"""Integers of 256 bits against Python's own."""

import random

from helpers import DAY, UNIT, ZERO, targets, topic, word
from pyspark.sql import functions as F

from tideledger.functions import codec, wide
from tideledger.operators import attribution as at, legs as lg
from tideledger.sources import logs as lo

A, B = "0x" + "a" * 40, "0x" + "b" * 40


def numbers():
    rnd = random.Random(4)
    edges = [0, 1, 2**96 - 1, 2**96, 2**120 - 1, 2**120, 2**192 - 1, 2**192, 2**255, 2**256 - 1, 10**18, 10**36, 10**77]
    return edges + [rnd.randrange(2 ** rnd.randrange(1, 257)) for _ in range(200)]


def test_words_and_signed_sums(spark):
    rows = [(i % 7, n, -1 if i % 3 == 0 else 1) for i, n in enumerate(numbers())]
    df = spark.createDataFrame([(g, word(n), s) for g, n, s in rows], "g int, w string, s int")
    one = wide.carried(wide.limbs(F.col("w")))
    got = df.select("w", wide.as_text(one).alias("t"), wide.as_double(one).alias("d"), wide.as_decimal(one).alias("x")).collect()
    for r in got:
        n = int(r["w"], 16)
        assert r["t"] == str(n) and abs(r["d"] - float(n)) <= 2**-52 * float(n) and (int(r["x"]) == n if n < 2**120 else r["x"] is None)
        assert n >= 2**120 or r["d"] == float(n)
    signed = F.when(F.col("s") < 0, wide.times(wide.limbs(F.col("w")), -1)).otherwise(wide.limbs(F.col("w")))
    sums = df.select("g", signed.alias("v")).groupBy("g").agg(wide.total(F.col("v")).alias("v"))
    assert "SortAggregate" not in sums._jdf.queryExecution().executedPlan().toString()
    sums = sums.select("g", wide.as_text(wide.carried(F.col("v"))).alias("t"), wide.is_positive(wide.carried(F.col("v"))).alias("p"))
    want = {g: sum(n * s for h, n, s in rows if h == g) for g in range(7)}
    assert {r["g"]: (r["t"], r["p"]) for r in sums.collect()} == {g: (str(v), v > 0) for g, v in want.items()}


def log(topic0, topics, words, li=1, tx="t", address="tok"):
    t = topics + [None] * (3 - len(topics))
    return ("main", 100, li, DAY, address, topic0, *t, "0x" + "".join(word(w) for w in words), tx)


def test_wide_amounts_stay_exact_in_every_event(spark):
    big, more = 2**255 + 12345, 2**130
    logs = spark.createDataFrame([
        log(codec.TRANSFER_TOPIC, [topic(ZERO), topic(A)], [big]), log(codec.TRANSFER_TOPIC, [topic(A), topic(B)], [big - 5 * UNIT], 2),
        log(codec.STAKED_TOPIC, [topic(A)], [big], 3), log(codec.SWAP_TOPIC, [topic(A), topic(A), topic(B)], [1, more, 7], 4),
        log(codec.DEPOSIT_TOPIC, [topic(A)], [3 * more, 2 * more], 5)], lo.LOG_SCHEMA)
    text = lambda c: wide.as_text(wide.carried(F.col(c)))
    assert [r[0] for r in lo.transfers(logs).orderBy("log_index").select(text("amount_wide")).collect()] == [str(big), str(big - 5 * UNIT)]
    assert lo.stakes(logs).select(text("amount_wide")).first()[0] == str(big) and lo.swaps(logs).select(text("amount_out_wide")).first()[0] == str(more)
    flow = lo.vault_flows(logs).select(text("assets_wide"), text("shares_wide")).first()
    assert tuple(flow) == (str(3 * more), str(2 * more))
    legs = lg.transaction_legs(lo.transfers(logs), [], targets(spark)).collect()
    assert {r["user_addr"]: r["amount_change"] for r in legs} == {A: 5.0, B: float(big - 5 * UNIT) / 1e18}   # two wide legs, an exact small difference
    staked = lg.stake_legs(lo.stakes(logs), at.real_codes(lo.referrals(logs)), targets(spark)).first()
    assert staked["amount_change"] == float(big) / 1e18
    from tideledger.operators import conversion as cv

    assert cv.last_rate_of_day(lo.vault_flows(logs)).first()["rate"] == 1.5
