"""Opening legs of a window, with and without the state at its end."""

from __future__ import annotations

from datetime import date

from helpers import LEG_SCHEMA

from tideledger.operators import state as st

START, END = date(2025, 1, 3), date(2025, 1, 5)
S = 1735689600  # 2025-01-01


def leg(user, block, day, change, code=None):
    return ("main", "tok", "sUSDS", user, block, 0, 0, S + day * 86400, float(change), code)


def test_who_acted_shows_in_the_state_after(spark):
    # a holds; b is empty and comes back; c is empty and stays away; d is new; e has no name and is empty.
    legs = spark.createDataFrame(
        [leg("a", 1, 0, 5, 7), leg("b", 2, 0, 5, 8), leg("b", 3, 1, -5), leg("c", 4, 0, 5, 9), leg("c", 5, 1, -5), leg("b", 6, 2, 3),
         leg("d", 7, 3, 4, 6), leg(None, 8, 0, 0, 5), leg(None, 9, 2, 0)], LEG_SCHEMA)
    before = st.partial_state(legs.filter(f"ts < {S + 2 * 86400}"))
    after = st.partial_state(legs)
    inside = st.of_window(legs, START, END)
    plain, quick = st.opened_legs(before, inside, START), st.opened_legs(before, inside, START, after=after)
    assert sorted(map(str, plain.collect())) == sorted(map(str, quick.collect()))
    opened = {r["user_addr"]: (r["amount_change"], r["ref_code"]) for r in quick.collect() if r["block"] == -1}
    assert opened == {"a": (5.0, 7), "b": (0.0, 8)}
