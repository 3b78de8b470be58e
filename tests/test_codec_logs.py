"""Hex decoding and log scans."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import word
from tideledger.functions import codec
from tideledger.sources import logs as lo

ROWS = [
    # blockchain, block, index, time, address, topic0..3, data, tx
    ("main", 1, 0, 10, "0xaa", "T", "x", "y", None, "0x", "t1"),
    ("main", 2, 0, 20, "0xaa", "T", "x", "z", None, "0x", "t2"),
    ("main", 3, 1, 30, "0xbb", "S", "q", "y", None, "0x", "t3"),
    ("main", 3, 2, 30, "0xcc", "T", "x", "y", None, "0x", "t3"),
]


@pytest.fixture(scope="module")
def logs(spark):
    return spark.createDataFrame(ROWS, lo.LOG_SCHEMA)


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "v string").select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("n", [0, 1, 2**53 + 3, 10**23 + 7, 2**60, 2**120 - 1])
def test_uint_is_exact(spark, n):
    assert int(one(spark, word(n), codec.uint)) == n
    assert one(spark, word(n), codec.uint_overflows) is False


@pytest.mark.parametrize("n", [2**120, 2**128 + 5, 2**256 - 1])
def test_too_wide_values_are_null_and_reported(spark, n):
    assert one(spark, word(n), codec.uint) is None
    assert one(spark, word(n), codec.uint_overflows) is True


def test_empty_word_is_zero(spark):
    assert int(one(spark, "", codec.uint)) == 0


def test_addresses(spark):
    a = "0x" + "Ab" * 20
    t = one(spark, a, codec.address_topic)
    assert t == "0x" + "0" * 24 + "ab" * 20
    assert one(spark, t, codec.topic_address) == a.lower()
    with pytest.raises(PySparkException):
        one(spark, "0x" + "a" * 41, codec.address_topic)


def test_swap_code_uses_last_word(spark):
    data = "0x" + word(7) + word(8) + word(42)
    assert one(spark, data, codec.swap_code) == 42
    assert one(spark, "0x", codec.swap_code) == 0
    assert one(spark, "0x" + word(2**200), codec.swap_code) >= 10**9  # malformed: above every valid code


def test_selections(logs):
    def hit(*sel, a=None, b=None):
        return {(r["block_number"], r["log_index"]) for r in lo.select_logs(logs, sel, a, b).collect()}

    assert hit({"address": ["0xAA"], "topics": [["T"]]}) == {(1, 0), (2, 0)}
    assert hit({"address": ["0xaa"], "topics": [["T"], [], ["y"]]}) == {(1, 0)}
    assert hit({"topics": [["T"], ["x"]]}, {"address": ["0xbb"]}) == {(1, 0), (2, 0), (3, 1), (3, 2)}
    assert hit({"topics": [["T"]]}, {"topics": [[], ["x"]]}, a=2, b=3) == {(2, 0), (3, 2)}


def test_unknown_block_fails(spark, logs):
    blocks = spark.createDataFrame([("main", 1, 10), ("main", 2, 20)], "blockchain string, block_number bigint, block_time bigint")
    with pytest.raises(PySparkException, match="no timestamp for block 3"):
        lo.attach_block_time(logs, blocks).collect()


def test_block_lookup(spark):
    blocks = spark.createDataFrame([("a", 5, 100), ("a", 6, 200), ("b", 9, 500)], "blockchain string, block_number bigint, block_time bigint")
    chains = spark.createDataFrame([("a",), ("b",)], "blockchain string")
    found = {r["blockchain"]: r["block_number"] for r in lo.block_at_or_before(blocks, 250, chains).collect()}
    assert found == {"a": 6, "b": 0}
    assert lo.block_at_or_before(blocks, 10).isEmpty()


def test_captures_plain_and_gzip(spark, logs, tmp_path):
    import gzip
    import json

    rows = [dict(zip(lo.LOG_SCHEMA.names, r)) for r in ROWS]
    (tmp_path / "a.json").write_text(json.dumps(rows[:2]))
    with gzip.open(tmp_path / "b.json.gz", "wt") as f:
        json.dump(rows[1:], f)
    assert lo.read_captures(spark, str(tmp_path)).count() == 5
    assert lo.dedupe_logs(lo.read_captures(spark, str(tmp_path))).count() == 4


def test_scan_prunes_and_pushes_down(spark, logs, tmp_path):
    path = str(tmp_path / "logs")
    logs.write.parquet(path)
    wanted = lo.select_logs(spark.read.parquet(path), [{"address": ["0xaa"], "topics": [["T"]]}], 1, 2).select("transaction_hash")
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(address,0xaa)" in plan.replace("In(address, [0xaa])", "EqualTo(address,0xaa)")
    assert "ReadSchema: struct<block_number:bigint,address:string,topic0:string,transaction_hash:string>" in plan
