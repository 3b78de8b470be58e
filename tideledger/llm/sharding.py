"""Sharding by fixed virtual slots.

Records hash into a fixed number of slots, bytes are summed per slot, and a small
versioned map says which shard holds each slot. Only the map changes when shards
are added or sizes drift: a rebalance moves whole slots, as few as it can, and
writes the next version. The map has one row per slot whatever the data, so it
may be folded in one place; records are only touched by partial sums and by one
shuffle of (id, size, checksum) rows for their numbers.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import shared_folder, stored

SLOTS = 4096
OVERHEAD = 16  # bytes a record takes besides its text


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot ``vslot`` of each row.

    A null text counts as empty. Repeated doc_ids are rows of their own; the text takes
    part in the hash, so a repeated or null doc_id with many texts does not fill one slot.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
    ).withColumn("vslot", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(slots)).cast("int"))


def slot_bytes(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Bytes per slot, one row for every slot; summed before the shuffle."""
    every = rows.sparkSession.range(slots).select(F.col("id").cast("int").alias("vslot"))
    return every.join(rows.groupBy("vslot").agg(F.sum("size").alias("bytes")), "vslot", "left").select(
        "vslot", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"))


def _deal(ordered: Column, loads: Column) -> Column:
    """Fold slots, largest first, each onto the shard with the least bytes so far."""
    def step(state: Column, slot: Column) -> Column:
        least = F.array_min(F.transform(state["loads"], lambda load, i: F.struct(load.alias("load"), i.alias("shard"))))
        return F.struct(
            F.transform(state["loads"], lambda load, i: F.when(i == least["shard"], load + slot["bytes"]).otherwise(load)).alias("loads"),
            F.concat(state["placed"], F.array(F.struct(slot["vslot"].alias("vslot"), slot["bytes"].alias("bytes"), least["shard"].alias("shard")))).alias("placed"),
        )

    start = F.struct(loads.alias("loads"), F.array().cast("array<struct<vslot:int,bytes:bigint,shard:int>>").alias("placed"))
    return F.aggregate(ordered, start, step, lambda state: state["placed"])


def _map(placed: DataFrame, version: int) -> DataFrame:
    return placed.select(F.explode("placed").alias("p")).select(F.lit(version).alias("version"), "p.vslot", "p.shard", "p.bytes")


def _largest_first(loads: DataFrame) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "vslot"))),
                       lambda s: F.struct(s["vslot"].alias("vslot"), (-s["less"]).alias("bytes")))


def first_map(loads: DataFrame, shards: int) -> DataFrame:
    """Version 0: slots dealt by size, so that shards hold nearly the same bytes."""
    zero = F.array_repeat(F.lit(0).cast("long"), shards)
    return _map(loads.agg(_largest_first(loads).alias("slots")).select(_deal(F.col("slots"), zero).alias("placed")), 0)


def rebalance(old: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """The next version for ``shards`` shards: slots stay where they are unless their shard is gone or holds over an equal share.

    Each shard keeps its largest slots up to an equal share of the new bytes; what is left over is dealt to the emptiest.
    """
    version = old.agg(F.max("version")).first()[0] + 1
    now = old.select("vslot", "shard").join(loads, "vslot")
    share = F.expr("sum(bytes) over ()") / shards
    kept = now.withColumn("share", share).withColumn("until", F.expr(
        "sum(bytes) over (partition by shard order by bytes desc, vslot)")).withColumn(
        "stays", (F.col("shard") < shards) & (F.col("until") <= F.col("share")))
    kept = stored(kept.select("vslot", "bytes", "shard", "stays"), "slot-map-kept")
    held = kept.where("stays").groupBy("shard").agg(F.sum("bytes").alias("held"))
    every = kept.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    loads_now = every.join(held, "shard", "left").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("shard", F.coalesce("held", F.lit(0)).cast("long").alias("held")))), lambda s: s["held"]).alias("loads"))
    moving = kept.where("not stays").agg(_largest_first(kept).alias("slots"))
    dealt = _map(moving.join(loads_now).select(_deal(F.col("slots"), F.col("loads")).alias("placed")), version)
    stay = kept.where("stays").select(F.lit(version).alias("version"), "vslot", "shard", "bytes")
    return stay.unionByName(dealt)


def new_store(spark: SparkSession) -> str:
    """A new place for the versions of a map, in the shared folder."""
    return f"{shared_folder(spark)}/slot-map-{uuid.uuid4().hex}"


def save(mapped: DataFrame, path: str) -> DataFrame:
    """Write a version beside the earlier ones and read it back."""
    version = mapped.agg(F.max("version")).first()[0]
    mapped.coalesce(1).write.parquet(f"{path}/{version:06d}")
    return mapped.sparkSession.read.schema(mapped.schema).parquet(f"{path}/{version:06d}")


def place(rows: DataFrame, mapped: DataFrame) -> DataFrame:
    """Shard and number of each row: numbers run from 0 without gaps in every shard.

    Rows are numbered inside their virtual slot; the slots' counts give each slot its first number.
    """
    counts = rows.groupBy("vslot").agg(F.count("*").alias("n"))
    starts = mapped.select("vslot", "shard").join(counts, "vslot").withColumn(
        "start", F.expr("sum(n) over (partition by shard order by vslot) - n")).select("vslot", "shard", "start")
    numbered = rows.withColumn("at", F.expr("row_number() over (partition by vslot order by doc_id, text_crc32, size) - 1"))
    return numbered.join(starts, "vslot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("at")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "vslot")


def shard(docs: DataFrame, shards: int = 40, slots: int = SLOTS) -> DataFrame:
    """``docs`` (doc_id, text) dealt to ``shards`` shards of nearly equal bytes; an empty table gives no rows."""
    rows = stored(records(docs, slots), "shard-records")
    mapped = save(first_map(slot_bytes(rows, slots), shards), new_store(docs.sparkSession))
    return place(rows, mapped)
