"""Near copies for the pipeline: SimHash fingerprints, exact similarity of five-word shingles, components, one text of each.

Two texts are near copies when their fingerprints differ in two bits or less (:mod:`simhash`: three-word shingles, band pairs,
pivot distance table, verified bit by bit), or when the Jaccard similarity of their sets of ``WIDTH``-word shingles is
``SIMILAR`` or more, which fingerprints often miss. Both kinds of links make the components. Candidates for the second kind share one of ``BANDS`` groups of ``ROWS`` minima of seeded hash
functions: a pair at 0.8 shares none with probability (1 - 0.8^5)^30 < 1e-5. Each of them is
verified on the shingle sets, so the bands only decide what is looked at.

A band's members first meet its two outermost keys. Members that are connected then need no further look; of the others, every two
in different components are compared while the band has at most ``CROWD`` members. Those of larger bands meet by prefix instead: with all shingles
in one order, the rarest first, two sets of that similarity share a shingle so early in both that
the rest of either still holds what they must have in common. Shingles of one text only come first and meet nothing, so texts that
differ from all others in more than a ninth of their shingles are not compared at all, and none of similarity 0.8 is lost.
A large group of copies costs its size, and so does one whose texts each differ in more; texts that differ from each other in little more than
0.8 allows may all meet, and then only within the join.

Before anything is fetched, two texts must agree in the parities of their shingles' numbers under 256 places: a shingle that only one of
them has changes one place, so they differ in no more places than shingles. The shingle sets themselves, several times their text,
are made for texts that pass this with another one, and for those of crowded bands.
"""

from __future__ import annotations

import functools

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import shipped, simhash
from .common import passing, release, stored
from .components import components
from .simhash import least_of_components, row_key, split_words

shipped(__name__)

WIDTH, SIMILAR = 5, 0.8
SHINGLE, RADIUS = 3, 2  # of the fingerprints, as in op6
BANDS, ROWS = 30, 5
SKETCHED = 256  # texts sketched at a time
CROWD = 64  # members of a band compared with all others
PLACES = 256  # of parities
_SEEDS = np.array([[xxhash.xxh64_intdigest(f"{kind} {i}", 0) | (kind == "times") for i in range(BANDS * ROWS)]
                   for kind in ("xor", "times")], np.uint64)


def shingles(words: list[str], width: int = WIDTH) -> np.ndarray:
    """The distinct XXH64 values of the shingles; fewer words than ``width`` are one shingle, and so are none."""
    digest = xxhash.xxh64_intdigest
    n = max(len(words) - width + 1, 1)
    return np.unique(np.fromiter((digest(" ".join(words[i:i + width]).encode("utf-8", "surrogatepass")) for i in range(n)), np.uint64, n))


def bands(grams: np.ndarray) -> np.ndarray:
    """A key for each band: the minima of its hash functions over the shingles."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for part in range(0, len(grams), 2048):  # bounded memory for very long texts
        mixed = (grams[part:part + 2048, None] ^ _SEEDS[0]) * _SEEDS[1]
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(32))).min(axis=0))
    rows = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(rows)], np.uint64)


def parities(grams: np.ndarray) -> np.ndarray:
    """One bit for each of ``PLACES`` places: whether an odd number of the shingles fall on it."""
    counts = np.bincount((grams % np.uint64(PLACES)).astype(np.int64), minlength=PLACES)
    return np.packbits(counts & 1, bitorder="little").view(np.int64)


def _sketched(docs: DataFrame) -> DataFrame:
    """key, number of shingles n, their parities, bands and fingerprint of each distinct text."""
    def run(batches):
        import pyarrow as pa

        many = pa.list_(pa.int64())
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for begin in range(0, len(texts), SKETCHED):  # few texts at a time: shingles are several times their text
                part = range(begin, min(begin + SKETCHED, len(texts)))
                words = [split_words(texts[i].as_py()) for i in part]
                grams = [shingles(w) for w in words]
                fps = np.array([simhash.fingerprint(w, SHINGLE) for w in words], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(begin, len(part)), pa.array([len(g) for g in grams], pa.int32()), pa.array([parities(g) for g in grams], many),
                     pa.array([bands(g).view(np.int64) for g in grams], many), pa.array(fps)],
                    names=["key", "n", "odd", "bands", "fp"])
        release()

    texts = docs.select(row_key(F.col("text")).alias("key"), "text").dropDuplicates(["key"])
    return texts.mapInArrow(run, "key binary, n int, odd array<long>, bands array<long>, fp long")


def _sets(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """key and shingles of each distinct text whose key is among ``keys``."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found, texts = batch.column(0), batch.column(1)
            for begin in range(0, len(texts), SKETCHED):
                part = range(begin, min(begin + SKETCHED, len(texts)))
                grams = [shingles(split_words(texts[i].as_py())).view(np.int64) for i in part]
                yield pa.RecordBatch.from_arrays([found.slice(begin, len(part)), pa.array(grams, pa.list_(pa.int64()))], names=["key", "grams"])
        release()

    wanted = keys.select("key").distinct()
    rows = docs.select(row_key(F.col("text")).alias("key"), "text").withColumn("slot", F.xxhash64("key"))
    rows = passing(rows, "slot", wanted.select(F.xxhash64("key").alias("key")))
    texts = rows.dropDuplicates(["key"]).join(wanted, "key", "left_semi").select("key", "text")
    return texts.mapInArrow(run, "key binary, grams array<long>")


def fingerprint_links(sketched: DataFrame) -> DataFrame:
    """Pairs (a, b) of keys that connect the texts of each fingerprint, and those of fingerprints within ``RADIUS`` bits."""
    named = stored(sketched.groupBy("fp").agg(F.min("key").alias("first")), "near-fingerprints")
    same = sketched.select("key", "fp").join(named, "fp").where("first < key").select(F.col("first").alias("a"), F.col("key").alias("b"))
    low, high = (named.select(F.col("fp").alias(f"{end}_fp"), F.col("first").alias(end)) for end in ("a", "b"))
    near = simhash.links(named.select("fp"), RADIUS).select(F.col("a").alias("a_fp"), F.col("b").alias("b_fp"))
    return same.unionByName(near.join(low, "a_fp").join(high, "b_fp").select("a", "b"))


def _least_common(similar: float) -> Column:
    """The least number of shingles that texts a and b have in common if they are near copies."""
    return F.ceil(similar / (1 + similar) * (F.col("a.n") + F.col("b.n")) - 1e-9)


def _may_be_alike(similar: float) -> Column:
    """False only where sizes or parities show that a and b are no near copies."""
    differing = functools.reduce(Column.__add__, (F.bit_count(F.get("a.odd", F.lit(i)).bitwiseXOR(F.get("b.odd", F.lit(i)))) for i in range(PLACES // 64)))
    least = _least_common(similar)
    return (F.least("a.n", "b.n") >= least) & (differing <= F.col("a.n") + F.col("b.n") - 2 * least)


def _pairs(met: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b, of the keys of a join's two sides."""
    return met.select(F.least("a.key", "b.key").alias("a"), F.greatest("a.key", "b.key").alias("b")).distinct()


def _keys(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("key"))


def _verified(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    left, right = sets.select(F.col("key").alias("a"), F.col("grams").alias("x")), sets.select(F.col("key").alias("b"), F.col("grams").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    alike = common >= similar * (F.size("x") + F.size("y") - common) - 1e-9
    return pairs.join(right, "b").join(left, "a").where(alike).select("a", "b")


def _prefix_pairs(crowd: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """Pairs (a, b) of different components of ``crowd`` (key, n, odd, of): all near copies, and few others.

    Of the shingles in order, a's first one in common with b has all others in common after it, and so has b's.
    """
    every = crowd.join(sets, "key").select("key", "n", F.explode("grams").alias("gram"))
    shared = stored(every.groupBy("gram").agg(F.count("*").alias("texts")).where("texts > 1"), "near-grams")
    own = Window.partitionBy("key")
    placed = passing(every, "gram", shared.select(F.col("gram").alias("key"))).join(shared, "gram").withColumn("at", F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("texts", "gram")) - 1)
    early = placed.where(F.col("at") <= F.col("n") - F.ceil(similar * F.col("n") - 1e-9)).select("key", "gram", "at")
    early = stored(early.join(crowd, "key"), "near-prefixes")
    a, b = early.alias("a"), early.alias("b")
    in_time = (F.col("a.at") <= F.col("a.n") - _least_common(similar)) & (F.col("b.at") <= F.col("b.n") - _least_common(similar))
    return _pairs(a.join(b, F.expr("a.gram = b.gram and a.key < b.key and a.of != b.of") & in_time & _may_be_alike(similar)))


def links(docs: DataFrame, sketched: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Pairs (a, b) of keys of near copies; two near copies by fingerprint, or by similarity if they share a band, are always connected by such pairs."""
    keyed = sketched.select("key", "n", "odd", F.explode("bands").alias("band"))
    groups = stored(keyed.groupBy("band").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("members")).where("low < high"), "near-groups")
    grouped = stored(passing(keyed, "band", groups.select(F.col("band").alias("key"))).join(groups, "band"), "near-bands")
    members, ends = grouped.alias("a"), grouped.where("key = low or key = high").alias("b")
    first = stored(_pairs(members.join(ends, F.expr("a.band = b.band and a.key != b.key") & _may_be_alike(similar))), "near-ends")
    sets = stored(_sets(docs, _keys(first)), "near-sets")
    found = stored(_verified(first, sets, similar).unionByName(fingerprint_links(sketched)), "near-first")
    label = components(found)
    inner = grouped.where("members > 3 and key != low and key != high")  # of three members, an end meets each
    placed = stored(inner.join(label, inner["key"] == label["node"], "left").select("band", "key", "n", "odd", "members", F.coalesce("component", "key").alias("of")), "near-placed")
    mixed = placed.groupBy("band").agg(F.min("of").alias("least"), F.max("of").alias("most")).where("least < most").select("band")
    placed = stored(placed.join(mixed, "band", "left_semi"), "near-mixed")
    small = placed.where(F.col("members") <= CROWD)
    a, b = small.alias("a"), small.alias("b")
    rest = stored(_pairs(a.join(b, F.expr("a.band = b.band and a.key < b.key and a.of != b.of") & _may_be_alike(similar))), "near-rest")
    crowd = stored(placed.where(F.col("members") > CROWD).select("key", "n", "odd", "of").distinct(), "near-crowd")
    sets = stored(_sets(docs, _keys(rest).unionByName(crowd.select("key"))), "near-sets")
    if not crowd.isEmpty():
        rest = rest.unionByName(_prefix_pairs(crowd, sets, similar)).distinct()
    return found.unionByName(_verified(rest, sets, similar))


def representatives(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """One row of each component of near copies, with all its columns: the least (doc_id, text key), null doc_ids last.

    Null and empty texts are copies of each other; of rows equal in doc_id and text, one stays.
    """
    sketched = stored(_sketched(docs), "near-sketches")
    label = stored(components(links(docs, sketched, similar)), "near-components")
    rows = docs.select("doc_id", row_key(F.col("text")).alias("key"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("key"))
    least = rows.groupBy("key").agg(F.min(place).alias("place"))  # combined before the shuffle
    return least_of_components(docs, least.join(label, least["key"] == label["node"], "left").select(
        F.coalesce("component", "key").alias("component"), "place"))
