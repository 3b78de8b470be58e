"""Positions of regular-expression matches as DataFrame expressions.

``split`` gives the text between matches and ``regexp_extract_all`` the matches;
both walk the same leftmost, non-overlapping matches, so their lengths add up to
offsets in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPAN = "struct<start:int,ord:int,end:int,kind:string,hit:string,before:string>"
START = "<start> "
NONE = f"array<{SPAN}>"


def none() -> Column:
    return F.array().cast(NONE)


def spans(text: Column, pattern: str, kind: str, order: int, guard: Column, context: int = 0) -> Column:
    """Every match of ``pattern`` in ``text``: start, end (exclusive), the match, and the last ``context`` characters before it.

    Earlier matches are part of what comes before a match, and so is a mark ``START`` at the text's start.

    ``pattern`` must not match the empty string. ``guard`` is a cheap condition
    that holds wherever a match is possible.
    """
    pairs = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1),
        lambda hit, gap: F.struct(hit.alias("hit"), F.length(gap).alias("gap"), F.length(hit).alias("size"),
                                  *((F.right(gap, F.lit(context)).alias("near"),) if context else ())),
    )
    last = lambda *parts: F.right(F.concat(*parts), F.lit(context)) if context else F.lit("")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        before = last(state["near"], pair["near"]) if context else F.lit("")
        span = F.struct(start.alias("start"), F.lit(order).alias("ord"), (start + pair["size"]).alias("end"),
                        F.lit(kind).alias("kind"), pair["hit"].alias("hit"), before.alias("before"))
        return F.when(pair["hit"].isNull(), state).otherwise(F.struct(
            (start + pair["size"]).alias("at"), F.concat(state["out"], F.array(span.cast(SPAN))).alias("out"),
            last(before, pair["hit"]).alias("near")))

    start = F.struct(F.lit(0).alias("at"), none().alias("out"), F.lit(START if context else "").alias("near"))
    return F.when(guard, F.aggregate(pairs, start, step, lambda state: state["out"])).otherwise(none())


def listing(found: Column) -> Column:
    """``kind:start:end`` by start, then by the order of the kinds, comma-joined."""
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"], s["ord"], s["end"], s["kind"])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == F.lit(kind))).cast("long")
