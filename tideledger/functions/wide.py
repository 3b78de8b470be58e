"""Exact integers of 256 bits and more as three decimal limbs.

A value is lo + mid * 2^96 + hi * 2^192 with signed limbs that need not be normalised, so a sum adds the limbs one by one, in
hash aggregates and in any order, for up to 10^9 rows of the widest words. Carries are resolved once, after the sum.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from tideledger.functions.codec import WORD, hex_body

LIMBS = ("lo", "mid", "hi")
TYPE = "struct<lo:decimal(38,0),mid:decimal(38,0),hi:decimal(38,0)>"
_LIMB_DIGITS = 24  # hex digits of lo and mid
_BASE = Decimal(1 << 96)
_TEN18 = Decimal(10**18)


def _big(value: int | Decimal) -> Column:
    return F.lit(Decimal(value)).cast("decimal(38,0)")


def _digits(word: Column, begin: int, n: int) -> Column:
    """Value of ``n`` hex digits, in pieces that fit a 64-bit integer."""
    out = _big(0)
    for at in range(begin, begin + n, 12):
        size = min(12, begin + n - at)
        piece = F.conv(F.substring(word, at, size), 16, 10).cast("decimal(38,0)")
        out = (out * _big(16**size) + piece).cast("decimal(38,0)")
    return out


def limbs(word: Column) -> Column:
    """Limbs of a 32-byte hex word; an empty word is 0."""
    padded = F.lpad(F.coalesce(hex_body(word), F.lit("")), WORD, "0")
    return F.struct(_digits(padded, 41, _LIMB_DIGITS).alias("lo"), _digits(padded, 17, _LIMB_DIGITS).alias("mid"), _digits(padded, 1, 16).alias("hi"))


def of(amount: Column) -> Column:
    """Limbs of an ordinary integer."""
    return F.struct(amount.cast("decimal(38,0)").alias("lo"), _big(0).alias("mid"), _big(0).alias("hi"))


def times(value: Column, sign: int) -> Column:
    return F.struct(*((value[name] * F.lit(sign)).cast("decimal(38,0)").alias(name) for name in LIMBS))


def total(value: Column) -> Column:
    """Sum aggregate; the result still has to be carried. Null rows count as nothing."""
    return F.struct(*(F.coalesce(F.sum(value[name]), _big(0)).cast("decimal(38,0)").alias(name) for name in LIMBS))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _split(value: Column, by: Decimal) -> Column:
    """Floor quotient ``q`` and remainder ``r``."""
    return _let(value, lambda v: _let(F.pmod(v, _big(by)).cast("decimal(38,0)"), lambda r: F.struct(
        ((v - r) / _big(by)).cast("decimal(38,0)").alias("q"), r.alias("r"))))


def carried(value: Column) -> Column:
    """lo and mid in 0 .. 2^96 - 1, the sign in hi."""
    return _let(value, lambda v: _let(_split(v["lo"], _BASE), lambda low: _let(
        _split((v["mid"] + low["q"]).cast("decimal(38,0)"), _BASE),
        lambda mid: F.struct(low["r"].alias("lo"), mid["r"].alias("mid"), (v["hi"] + mid["q"]).cast("decimal(38,0)").alias("hi")))))


def is_negative(normal: Column) -> Column:
    return normal["hi"] < 0


def is_positive(normal: Column) -> Column:
    return _let(normal, lambda n: (n["hi"] > 0) | ((n["hi"] == 0) & ((n["lo"] > 0) | (n["mid"] > 0))))


def _signed(normal: Column, body) -> Column:
    """``body`` of the absolute value's limbs and the sign."""
    return _let(normal, lambda n: _let(
        F.when(is_negative(n), carried(times(n, -1))).otherwise(n), lambda size: body(size, is_negative(n))))


def _small(size: Column, negative: Column) -> Column:
    fits = (size["hi"] == 0) & (size["mid"] < 1 << 24)
    value = (F.when(fits, size["mid"]) * _big(1 << 96) + size["lo"]).cast("decimal(38,0)")
    return F.when(negative, -value).otherwise(value).cast("decimal(38,0)")


def as_decimal(normal: Column) -> Column:
    """The value as decimal(38,0), null from 2^120 on."""
    return _signed(normal, _small)


def as_double(normal: Column) -> Column:
    """The nearest double where the value fits a decimal, else within one unit in the last place."""
    def made(size: Column, negative: Column) -> Column:
        rough = size["hi"].cast("double") * float(1 << 192) + size["mid"].cast("double") * float(1 << 96) + size["lo"].cast("double")
        return F.coalesce(_small(size, negative).cast("double"), F.when(negative, -rough).otherwise(rough))

    return _signed(normal, made)


def as_text(normal: Column) -> Column:
    """All decimal digits: the limbs are multiplied out in base 10^18 and the carries run through the cells."""
    weights = (1, 1 << 96, 1 << 192)

    def made(size: Column, negative: Column) -> Column:
        def cells(parts: list[Column]) -> Column:
            held = []
            for cell in range(5):
                terms = [(part[name] * _big(digit)).cast("decimal(38,0)") for part, weight in zip(parts, weights)
                         for j, name in enumerate(("r", "q")) if 0 <= cell - j < 5 and (digit := weight // 10 ** (18 * (cell - j)) % 10**18)]
                held.append(F.aggregate(F.array(*terms), _big(0), lambda a, b: (a + b).cast("decimal(38,0)")) if terms else _big(0))
            return F.array(*held)

        def step(state: Column, cell: Column) -> Column:
            return _let(_split((state["carry"] + cell).cast("decimal(38,0)"), _TEN18), lambda s: F.struct(
                s["q"].alias("carry"), F.concat(F.lpad(s["r"].cast("string"), 18, "0"), state["text"]).alias("text")))

        low, mid, high = (_split(size[name], _TEN18) for name in LIMBS)
        digits = _let(low, lambda x: _let(mid, lambda y: _let(high, lambda z: F.aggregate(
            cells([x, y, z]), F.struct(_big(0).alias("carry"), F.lit("").alias("text")), step, lambda state: state["text"]))))
        text = F.regexp_replace(digits, "^0+(?=.)", "")
        return F.when(negative, F.concat(F.lit("-"), text)).otherwise(text)

    return _signed(normal, made)
