"""Column expressions that decode hex event logs.

Every function returns a Column built from built-in expressions, so decoding
stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Event signatures (first log topic) and the zero address.
TRANSFER_TOPIC = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
REFERRAL_TOPIC = "0xb30a03a0e2a407f18ae0e83491331dc069d1521e292feffb071e61c8f7f40636"
STAKE_REFERRAL_TOPIC = "0x16902e34d01e8d5f80ce64939920a1390ff67f2546ae43ae72ac482033300968"
SWAP_TOPIC = "0xdba43ee9916cb156cc32a5d3406e87341e568126a46815294073ba25c9400246"
DEPOSIT_TOPIC = "0xdcbc1c05240f31ff3ad067ef1ee35ce4997762752e3a095284754544f4c709d7"
WITHDRAW_TOPIC = "0xfbde797d201c681b91056529119e0b02407c7bb96a4a2c75c01fc9667232c8db"
STAKED_TOPIC = "0x9e71bc8eea02a63969f509818f2dafb9254532904319f9dbda79b67bd34a5f3d"
WITHDRAWN_TOPIC = "0x7084f5476618d8e60b11ef0d7d3f06914655adb8793e28ff7f018d4c76d505d5"
ZERO_ADDRESS = "0x" + "0" * 40

WORD = 64  # hex digits in a 32-byte word
_LIMB = 15  # hex digits that always fit a signed 64-bit integer


def hex_body(c: Column) -> Column:
    """Lower-case hex digits without the 0x prefix."""
    text = F.lower(c)
    return F.when(text.startswith("0x"), F.substr(text, F.lit(3))).otherwise(text)


def topic_address(topic: Column) -> Column:
    """Low 20 bytes of a topic as a lower-case address."""
    padded = F.lpad(hex_body(topic), WORD, "0")
    return F.concat(F.lit("0x"), F.right(padded, F.lit(40)))


def address_topic(address: Column) -> Column:
    """Left-zero-padded topic of an address; a longer address is an error."""
    body = hex_body(address)
    checked = F.when(F.length(body) <= 40, F.lpad(body, WORD, "0")).otherwise(
        F.raise_error(F.concat(F.lit("bad address "), address))
    )
    return F.concat(F.lit("0x"), checked)


def data_word(data: Column, i: int) -> Column:
    """i-th 32-byte word of a data blob as hex digits (empty when absent)."""
    return F.substring(hex_body(data), 1 + WORD * i, WORD)


def word_count(data: Column) -> Column:
    return F.floor(F.length(hex_body(data)) / F.lit(WORD)).cast("int")


def _limb(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("decimal(20,0)")


def uint(word: Column) -> Column:
    """Exact unsigned value of a hex word as decimal(38,0); empty is 0.

    Values of 2^120 and more do not fit the decimal and give NULL; pair with
    :func:`uint_overflows` to report them.
    """
    padded = F.lpad(hex_body(word), WORD, "0")
    low = _limb(F.substring(padded, WORD - _LIMB + 1, _LIMB))
    high = _limb(F.substring(padded, WORD - 2 * _LIMB + 1, _LIMB))
    value = (high * F.lit(1 << 60).cast("decimal(19,0)") + low).cast("decimal(38,0)")
    return (
        F.when(F.coalesce(F.length(word), F.lit(0)) == 0, F.lit(0).cast("decimal(38,0)"))
        .when(uint_overflows(word), F.lit(None).cast("decimal(38,0)"))
        .otherwise(value)
    )


def uint_overflows(word: Column) -> Column:
    """True when a word needs more than 120 bits."""
    free = WORD - 2 * _LIMB
    return F.substring(F.lpad(hex_body(word), WORD, "0"), 1, free) != F.lit("0" * free)


def small_uint(word: Column) -> Column:
    """Value of a word expected to fit 60 bits; larger values give 2^60 - 1.

    Codes are compared with an upper bound, so saturating keeps malformed words
    above every valid code without failing the job.
    """
    padded = F.lpad(F.coalesce(hex_body(word), F.lit("")), WORD, "0")
    tail = F.substring(padded, WORD - _LIMB + 1, _LIMB)
    wide = F.substring(padded, 1, WORD - _LIMB) != F.lit("0" * (WORD - _LIMB))
    return F.when(wide, F.lit((1 << 60) - 1)).otherwise(F.conv(tail, 16, 10).cast("bigint"))


def referral_code(topic: Column) -> Column:
    """Code carried by an indexed topic."""
    return small_uint(topic)


def swap_code(data: Column) -> Column:
    """Code carried by the last whole word of the data; 0 without any word."""
    body = hex_body(data)
    words = F.floor(F.length(body) / F.lit(WORD)).cast("int")
    last = F.substring(body, (words - 1) * WORD + 1, F.lit(WORD))
    return F.when(words == 0, F.lit(0).cast("bigint")).otherwise(small_uint(last))


def flexible_number(text: Column) -> Column:
    """A number given as 0x-hex or as decimal digits."""
    return F.when(F.lower(text).startswith("0x"), small_uint(text)).otherwise(text.try_cast("bigint"))


def scaled(amount: Column, decimals: Column | int) -> Column:
    """Raw units to token units."""
    d = F.lit(decimals) if isinstance(decimals, int) else decimals
    return amount.cast("double") / F.pow(F.lit(10.0), d)
