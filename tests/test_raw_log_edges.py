"""Raw-log inputs that must neither merge nor vanish."""

from helpers import DAY, ZERO, targets, tr, transfers
from tideledger.operators import legs as lg
from tideledger.sources.registry import DeliveryProgram, programs_frame

A = "0xa"


def test_logs_without_a_hash_stay_apart(spark):
    moved = transfers(spark, [tr(None, 1, ZERO, A, 5, block=100), tr(None, 1, ZERO, A, 5, block=200, ts=DAY + 86400)])
    got = sorted((r["ts"], r["amount_change"]) for r in lg.transaction_legs(moved, [], targets(spark)).collect())
    assert got == [(DAY, 5.0), (DAY + 86400, 5.0)]


def test_no_program_delivers_in_a_log_without_a_hash(spark):
    programs = programs_frame(spark, (DeliveryProgram("p", 1003, ("prog",)),))
    moved = transfers(spark, [tr(None, 1, "prog", A, 5), tr("t", 2, "prog", "0xb", 5), tr("t", 3, ZERO, "prog", 5)])
    got = {r["user_addr"]: (r["amount_change"], r["ref_code"]) for r in lg.transaction_legs(moved, [], targets(spark), programs=programs).collect() if r["user_addr"] != "prog"}
    assert got == {A: (5.0, None), "0xb": (5.0, 1003)}
