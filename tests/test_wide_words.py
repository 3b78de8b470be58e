"""f4_wide_words on keys whose low halves pass 64 bits."""

from __future__ import annotations

import __spark_entry__ as entry


def test_low_half_beyond_a_long(spark, tmp_path):
    keys = [(0, 0), (1, 8191), (2, 8192), (3, 8192), (4, 14_999), (5, 90_000_000), (2**40, 90_000_000), (2**33, 8191)]
    spark.createDataFrame(keys, "o_orderkey bigint, o_custkey bigint").write.parquet(str(tmp_path / "orders.parquet"))
    want = {}
    for order, customer in keys:
        value = ((order * 1000003 + 7) << 100) + (customer << 50) + order
        n, total = want.get(customer, (0, 0))
        want[customer] = (n + 1, total + (-value if order % 3 == 0 else value))
    got = entry.queries()["f4_wide_words"](spark, str(tmp_path)).collect()
    assert {r["o_custkey"]: (r["n"], int(r["high"]), int(r["low"])) for r in got} == {
        customer: (n, total >> 100, total % (1 << 100)) for customer, (n, total) in want.items()}
