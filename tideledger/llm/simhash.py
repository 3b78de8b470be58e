"""SimHash near-duplicates: fingerprints, pivot distance tables, components.

Fingerprints are made in tasks with numpy. Equal fingerprints fall together before
anything is compared, so copies cost nothing. For every distinct fingerprint the
table of its Hamming distances to many fixed reference fingerprints is computed
once. A pair within r bits differs by r at most in each coordinate (triangle
inequality), so pairs with a larger difference in any coordinate are discarded
and the few others are verified bit by bit.

Which pairs are looked at: the 64 bits are cut into r + 2 bands; r differing bits leave
at least two bands untouched, so partners share the value of some two bands.
The join is on that key. Groups of fingerprints larger than ``CROWD`` are not
paired: there every member names the points one flipped bit away from it (in
steps for larger r, which is not needed here), and members that name the same
point are linked to the least of them. That is exact for r = 2, and linear.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from . import shipped
from .common import packed, stored, text_key
from .components import components

shipped(__name__)

BITS = 64
PIVOTS = 16
CROWD = 64
_LOWER = {c: c + 32 for c in range(65, 91)}
_SPACE = " \t\n\x0b\x0c\r"


def split_words(text: str | None) -> list[str]:
    """Words of an ASCII-lower-cased text between space, tab, line feed, vertical tab, form feed and return."""
    if not text:
        return []
    if text.isascii():
        text = text.lower()
        if not any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return text.split()
    else:
        text = text.translate(_LOWER)
    for c in _SPACE[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def fingerprint(words: list[str], shingle: int) -> int:
    """A bit is 1 if it is set in over half of the shingles' XXH64 values; no words give zero."""
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(" ".join(words[i:i + shingle]).encode("utf-8", "surrogatepass"), 42) for i in range(n)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for part in range(0, n, 65536):  # bounded memory for very long texts
        bits = np.unpackbits(hashes[part:part + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def row_key(text: Column) -> Column:
    """Names a text, null texts too."""
    return F.coalesce(text_key(text), F.lit(b""))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, text key and fingerprint ``fp`` (as a signed 64-bit number) of each row."""
    def run(batches):
        for batch in batches:
            fps = [fingerprint(split_words(t), shingle) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "key": batch["key"], "fp": np.array(fps, np.uint64).view(np.int64)})

    return docs.select("doc_id", "text", row_key(F.col("text")).alias("key")).mapInPandas(run, "doc_id long, key binary, fp long")


def pivots(count: int = PIVOTS) -> list[int]:
    """Reference fingerprints, fixed by a rule."""
    return [int(np.uint64(xxhash.xxh64_intdigest(f"pivot {i}", 0)).view(np.int64)) for i in range(count)]


def pivot_table(fps: DataFrame, count: int = PIVOTS) -> DataFrame:
    """Distances d0, d1, ... of each distinct fingerprint to the references."""
    return fps.select("fp", *(F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("byte").alias(f"d{i}")
                              for i, p in enumerate(pivots(count))))


def _band_keys(bands: int) -> list[int]:
    """Masks of every two bands of the 64 bits."""
    edges = [BITS * i // bands for i in range(bands + 1)]
    masks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(bands)]
    return [a | b for a, b in itertools.combinations(masks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, radius: int = 2, crowd: int = CROWD) -> DataFrame:
    """Pairs a < b of fingerprints; two fingerprints within ``radius`` bits are always connected by such pairs.

    fps: distinct fp. Pairs in ordinary groups are all listed; in crowds a spanning set is.
    """
    if radius != 2:
        raise ValueError("crowds are resolved for two differing bits")
    table = pivot_table(fps)
    masks = _band_keys(radius + 2)
    keyed = table.select("*", F.explode(F.array(*(
        F.struct(F.lit(i).cast("byte").alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part"))
        for i, m in enumerate(masks)))).alias("k")).select("*", "k.mask", "k.part").drop("k")
    sizes = keyed.groupBy("mask", "part").agg(F.count("*").alias("members")).where("members > 1")
    grouped = stored(keyed.join(sizes, ["mask", "part"]), "simhash-groups")

    near = F.greatest(*(F.abs(F.col(f"a.d{i}") - F.col(f"b.d{i}")) for i in range(PIVOTS))) <= radius
    small = grouped.where(F.col("members") <= crowd)
    pairs = (
        small.alias("a").join(small.alias("b"), (F.col("a.mask") == F.col("b.mask")) & (F.col("a.part") == F.col("b.part"))
                              & (F.col("a.fp") < F.col("b.fp")) & near)
        .where(F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= radius)
        .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    )
    # Crowds: members at most two bits apart share a point at most one bit from both.
    flips = F.array(F.lit(0).cast("long"), *(F.lit(_signed(1 << i)) for i in range(BITS)))
    points = (
        grouped.where(F.col("members") > crowd).select("fp").distinct()
        .select("fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("point"))
    )
    least = points.groupBy("point").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("point", "a")
    starred = points.join(least, "point").where("a < fp").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(starred).distinct()


def _classed(docs: DataFrame, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their fingerprint (doc_id, text key, fp), and the component of each fingerprint (fp, component)."""
    made = stored(fingerprints(docs, shingle), "fingerprints")
    distinct = stored(made.select("fp").distinct(), "fingerprint-ids")
    label = components(links(distinct, radius))  # node, component; only linked ones
    return made, stored(distinct.join(label, distinct["fp"] == label["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("component")), "fingerprint-components")


def classes(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id (smallest doc_id of the component) of each row.

    Null and empty texts have fingerprint zero and are linked like any other;
    rows with a null doc_id are classed too but never name a component unless no
    member has an id; repeated rows keep their number; other columns are ignored.
    """
    made, named = _classed(docs, shingle, radius)
    least = made.groupBy("fp").agg(F.min("doc_id").alias("least")).join(named, "fp")
    first = least.groupBy("component").agg(F.min("least").alias("component_id"))
    return made.join(named.join(first, "component").select("fp", "component_id"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of each component, with all its columns: the least (doc_id, text key), null doc_ids last.

    Of rows equal in both, one stays.
    """
    made, named = _classed(docs, shingle, radius)
    place = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("key"))
    return least_of_components(docs, made.groupBy("fp").agg(F.min(place).alias("place")).join(named, "fp"))  # combined before the shuffle


def least_of_components(docs: DataFrame, least: DataFrame) -> DataFrame:
    """The row of ``docs`` at the least place of each component; least: component, place (last, doc_id, key)."""
    kept = stored(least.groupBy("component").agg(F.min("place").alias("p")).select(
        F.col("p.doc_id").alias("keep_id"), F.col("p.key").alias("keep_key")), "representatives")
    keyed = packed(docs).withColumn("own_key", row_key(F.col("row.text")))
    chosen = keyed.join(kept, F.col("row.doc_id").eqNullSafe(F.col("keep_id")) & (F.col("own_key") == F.col("keep_key")), "left_semi")
    return chosen.withColumn("own_at", F.expr("row_number() over (partition by row.doc_id, own_key order by row.doc_id)")).where(
        "own_at = 1").select("row.*")
