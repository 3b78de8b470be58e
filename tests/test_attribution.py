"""Who is credited: deliveries, re-routed codes, precedence and termination."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import DAY, ZERO, ref, referrals, tags, targets, tr, transfers
from tideledger.operators import attribution as at, legs as lg
from tideledger.operators.twa import daily_twa
from tideledger.sources.registry import REROUTED_CODES, DeliveryProgram, programs_frame

S, A, R, D, E = "settle", "alice", "forwarder", "downstream", "named"
MAIN = DeliveryProgram("main", 1003, (S,))


def deliver(spark, rows, *programs):
    return tags(at.delivery_codes(transfers(spark, rows), programs_frame(spark, programs or (MAIN,))))


def reroute(spark, refs, rows, codes=REROUTED_CODES):
    return tags(at.rerouted_codes(referrals(spark, refs), transfers(spark, rows), codes))


def warm(owner, code, n=2):
    """More events elsewhere, so the owner counts as an intermediary."""
    return [ref(f"warm{i}", 1, owner, code) for i in range(n)]


def both_leg_layouts(spark, refs, rows, programs=(MAIN,), codes=REROUTED_CODES):
    """Legs per transfer and per transaction; both must attribute alike."""
    moves, named = transfers(spark, rows), referrals(spark, refs)
    registry = programs_frame(spark, programs)
    real, moved = at.real_codes(named), at.rerouted_codes(named, moves, codes)
    merged = at.merge_codes(real, moved, at.delivery_codes(moves, registry))
    return (lg.transfer_legs(moves, merged, targets(spark)),
            lg.transaction_legs(moves, [real, moved], targets(spark), programs=registry))


def codes_of(legs, user):
    return {r["ref_code"] for r in legs.filter(F.col("user_addr") == user).collect() if r["ref_code"] is not None}


def test_receiver_that_keeps_is_tagged(spark):
    assert deliver(spark, [tr("t1", 1, S, A, 100)]) == {("t1", A): (1, 1003)}


def test_forwarder_and_its_receiver_are_not(spark):
    assert deliver(spark, [tr("t1", 1, S, R, 50), tr("t1", 2, R, D, 50)]) == {}


def test_partial_forward_is_tagged(spark):
    assert deliver(spark, [tr("t1", 1, S, A, 100), tr("t1", 2, A, D, 30)])[("t1", A)] == (1, 1003)


def test_other_transactions_untouched(spark):
    assert deliver(spark, [tr("t3", 1, D, A, 10)]) == {}


def test_latest_delivery_decides(spark):
    other = DeliveryProgram("other", 1004, (R,))
    rows = [tr("t4", 1, S, A, 10), tr("t4", 2, R, A, 5)]
    assert deliver(spark, rows, MAIN, other)[("t4", A)] == (2, 1004)


def test_net_is_exact_beyond_double_precision(spark):
    rows = [tr("t1", 1, S, R, 2**53 + 3, raw=True), tr("t1", 2, R, D, 2**53 + 1, raw=True), tr("t1", 3, R, D, 2, raw=True)]
    assert deliver(spark, rows) == {}


@pytest.mark.parametrize("offset,expected", [(0, {}), (1, {("t1", A): (1, 1003)}), (2, {})])
def test_program_window(spark, offset, expected):
    windowed = DeliveryProgram("w", 1003, (S,), date(2025, 1, 2), date(2025, 1, 3))
    assert deliver(spark, [tr("t1", 1, S, A, 10, ts=DAY + offset * 86400)], windowed) == expected


def test_mint_canary_reports_untagged_recipient(spark):
    rows = [tr("t1", 1, S, A, 100), tr("t1", 2, ZERO, E, 30)]
    missed = at.untagged_mint_recipients(transfers(spark, rows), programs_frame(spark, (MAIN,)))
    assert [(r["tx_hash"], r["user_addr"]) for r in missed.collect()] == [("t1", E)]


def test_mint_canary_silent_for_forwarder(spark):
    rows = [tr("t1", 1, ZERO, R, 50), tr("t1", 2, R, S, 50), tr("t1", 3, S, A, 50)]
    program = programs_frame(spark, (MAIN,))
    assert at.untagged_mint_recipients(transfers(spark, rows), program).isEmpty()
    assert deliver(spark, rows) == {("t1", A): (3, 1003)}


def test_reroute_to_recipient(spark):
    assert reroute(spark, [ref("t1", 1, R, 1004)] + warm(R, 1004), [tr("t1", 2, R, A, 100)]) == {("t1", A): (2, 1004)}


def test_single_event_owner_is_no_intermediary(spark):
    refs, rows = [ref("t1", 1, E, 4011)], [tr("t1", 2, E, D, 100)]
    assert reroute(spark, refs, rows) == {}
    assert reroute(spark, refs + warm(E, 4011), rows) == {("t1", D): (2, 4011)}


def test_owner_that_keeps_is_not_rerouted(spark):
    rows = [tr("t1", 2, D, R, 100), tr("t1", 3, R, A, 10)]
    assert reroute(spark, [ref("t1", 1, R, 1004)] + warm(R, 1004), rows) == {}


def test_only_listed_codes_move(spark):
    assert reroute(spark, [ref("t1", 1, R, 1007)] + warm(R, 1007), [tr("t1", 2, R, A, 100)]) == {}


def test_reroute_skips_hops(spark):
    rows = [tr("t1", 2, R, D, 100), tr("t1", 3, D, A, 100)]
    assert reroute(spark, [ref("t1", 1, R, 1004)] + warm(R, 1004), rows) == {}


def test_reroute_skips_other_owners(spark):
    refs = [ref("t1", 1, R, 1004), ref("t1", 2, D, 4011)] + warm(R, 1004) + warm(D, 4011)
    assert reroute(spark, refs, [tr("t1", 3, R, D, 100)]) == {}


def test_real_code_beats_everything(spark):
    refs = [ref("t1", 1, R, 1004), ref("t1", 3, E, 777)] + warm(R, 1004)
    for legs in both_leg_layouts(spark, refs, [tr("t1", 2, R, E, 50), tr("t1", 4, S, E, 10)]):
        assert codes_of(legs, E) == {777}


def test_rerouted_beats_delivery(spark):
    refs = [ref("t2", 1, R, 1004)] + warm(R, 1004)
    for legs in both_leg_layouts(spark, refs, [tr("t2", 2, S, A, 30), tr("t2", 3, R, A, 20)]):
        assert codes_of(legs, A) == {1004}


def test_without_programs_no_codes(spark):
    moves = transfers(spark, [tr("t1", 1, S, A, 100)])
    real = at.real_codes(referrals(spark, [ref("x", 1, "nobody", 5)]))
    assert codes_of(lg.transfer_legs(moves, real, targets(spark)), A) == set()


@pytest.mark.parametrize("second", ["real", "rerouted"])
def test_later_signal_ends_a_tag(spark, second):
    day2 = DAY + 86400
    payer, refs, code = (D, [ref("t5", 2, A, 777, 200, day2)], 777) if second == "real" else (
        R, [ref("t5", 1, R, 1004, 200, day2)] + warm(R, 1004), 1004)
    rows = [tr("t1", 1, S, A, 100), tr("t5", 3, payer, A, 50, 200, day2)]
    for legs in both_leg_layouts(spark, refs, rows):
        got = {str(r["dt"]): r["ref_code"] for r in daily_twa(legs, date(2025, 1, 3)).filter(F.col("user_addr") == A).collect()}
        assert got == {"2025-01-01": 1003, "2025-01-02": code, "2025-01-03": code}


def test_excluded_holder_has_no_legs(spark):
    for legs in both_leg_layouts(spark, [ref("x", 1, "nobody", 5)], [tr("t1", 1, S, A, 100)]):
        assert codes_of(legs, A) == {1003}
        assert lg.drop_holders(legs, [A]).filter(F.col("user_addr") == A).isEmpty()


def test_tagging_only_relabels(spark):
    """The sum over codes is the same with and without programs."""
    rows = [tr("t1", 1, S, A, 100), tr("t2", 2, R, E, 50), tr("t3", 1, A, D, 20, 101, DAY + 500)]
    moves, named = transfers(spark, rows), referrals(spark, [ref("t2", 1, R, 1004)] + warm(R, 1004))
    real = at.real_codes(named)
    with_all = lg.transaction_legs(moves, [real, at.rerouted_codes(named, moves, REROUTED_CODES)], targets(spark), programs=programs_frame(spark, (MAIN,)))
    plain = lg.transaction_legs(moves, [real], targets(spark))
    total = lambda legs: daily_twa(legs, date(2025, 1, 5)).agg(F.sum("time_weighted_avg_balance")).first()[0]
    assert total(with_all) == pytest.approx(total(plain), rel=1e-12)
