"""Helpers shared by the operators: reading tables, stored intermediate tables, ASCII lower case, key filters."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import shipped

shipped(__name__)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tideledger-llm-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where it is unset on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it cuts lineage and survives a lost executor."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _kept() -> dict:
    import sys
    import types

    return vars(sys.modules.setdefault("tideledger_kept", types.SimpleNamespace()))


def kept(key: str, make):
    """``make()``, which this process keeps for later tasks until a task of another step calls :func:`release`."""
    held = _kept()
    if key not in held:
        held[key] = make()
    return held[key]


def release(keep: str = "") -> None:
    """Drop what the process has :func:`kept` except under ``keep``, and give freed memory back to the system.

    Called at a task's end, so that a Python worker that waits for its next task stays small.
    """
    import ctypes
    import gc

    import pyarrow as pa

    held = _kept()
    for key in [k for k in held if k != keep]:
        del held[key]
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often and inside whatever lambda ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def packed(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` as one struct ``row``: names made by an operator cannot meet the caller's; ``select("row.*")`` unpacks it."""
    return docs.select(F.struct("*").alias("row"))


def text_key(text: Column) -> Column:
    """16 bytes naming a text; results that depend on the text alone are joined by it."""
    return F.unhex(F.md5(text))


def slot_filter(keys: DataFrame, bits: int):
    """A test on 64-bit keys that lets every key of ``keys`` (column ``key``) pass, and few others.

    It holds 2^bits flags whatever the number of keys, so it is safe to send
    along with the plan; with very many keys it only loses its effect.
    """
    mask = (1 << bits) - 1
    slot = F.col("key").bitwiseAND(F.lit(mask)) + 1  # bit positions count from 1
    maps = (
        keys.groupBy(F.bitmap_bucket_number(slot).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
        .collect()  # at most 2^bits / 32768 rows of 4 KB
    )
    flags = bytearray(1 << bits)
    for row in maps:
        base = (row["bucket"] - 1) * 32768
        for at, byte in enumerate(row["bits"]):
            for bit in range(8) if byte else ():
                if byte >> bit & 1:
                    flags[base + at * 8 + bit] = 1
    literal = F.lit(bytes(flags))

    def passes(key: Column) -> Column:
        return F.substring(literal, key.bitwiseAND(F.lit(mask)).cast("int") + 1, 1) == F.lit(b"\x01")

    return passes


WORD_BITS = 18


def passing(rows: DataFrame, column: str, keys: DataFrame, bits: int = WORD_BITS) -> DataFrame:
    """The rows whose 64-bit ``column`` may be among ``keys`` (column ``key``): every one that is, and few others.

    The keys become one bit each of at most 2^bits words of 64 bits, a broadcast table of
    known size (2^18 words of two longs) whatever their number; with very many keys it only loses its effect.
    """
    def word(key: Column) -> Column:
        return F.shiftrightunsigned(key, 6).bitwiseAND(F.lit((1 << bits) - 1))

    def bit(key: Column) -> Column:
        return key.bitwiseAND(F.lit(63)).cast("int")

    one = F.expr("shiftleft(1L, cast(key & 63 as int))")
    words = keys.groupBy(word(F.col("key")).alias("filter_word")).agg(F.bit_or(one).alias("filter_bits"))
    at = F.col(column)
    hit = F.getbit(F.col("filter_bits"), bit(at)) == 1
    return rows.join(F.broadcast(words), (word(at) == F.col("filter_word")) & hit).select(*(rows[c] for c in rows.columns))
