"""I-Match fingerprints with randomised lexicon subsets.

Document frequencies are counted over all texts; the lexicon holds the terms whose inverse document frequency lies
in a band, neither the very common nor the rare ones. A text keeps its distinct lexicon terms in sorted order, and
the terms that fall into each of 120 random subsets of the lexicon are hashed. The subsets come in eight sizes, from an eighth
of the lexicon to a two-thousandth, so that texts of any length have subsets which single edits leave alone: the share of
equal hashes measures likeness.

Every term of the band is in at least one document of ``1 / LOW``, so the lexicon has at most (mean
distinct terms a text) / LOW terms however large the corpus; it travels as a table of flags of fixed size. Texts
meet their neighbours after one shuffle by ranges of doc_id.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import let, lower_ascii, slot_filter

LOW, HIGH = 1 / 100, 1 / 8   # the band: share of all documents that hold a term
LEAST = 8                    # a text with fewer lexicon terms is named by all its terms
FLAGS = 18                   # bits of a place in the flags; a term outside the band passes by accident with the third power of their load
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# (e, n): n subsets that hold 2^-e of the lexicon each; those of the first level hold every term.
LEVELS = ((3, 8), (5, 16), (6, 16), (7, 16), (8, 16), (9, 16), (10, 16), (11, 16))
SLOT_ROWS, MOST_RANGES, MOST_PARTS = 1024, 1024, 64


def terms(text: Column) -> Column:
    """Names (64-bit hashes) of the distinct words of a text."""
    words = F.filter(F.split(lower_ascii(text), SPLIT), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Names of the terms that occur in a share of ``low`` to ``high`` of all documents."""
    n = docs.count()
    held = docs.select(F.explode(terms(F.col("text"))).alias("name")).groupBy("name").agg(F.count("*").alias("df"))
    return held.where(F.col("df").between(low * n, high * n)).select("name")


def _places(name: Column) -> list[Column]:
    mask = F.lit((1 << FLAGS) - 1)
    return [F.shiftrightunsigned(name, shift).bitwiseAND(mask) for shift in (0, FLAGS, 2 * FLAGS)]


def in_lexicon(names: DataFrame):
    """A test on names: true for every name of ``names`` (column ``name``) and, by accident, for few others; the same for every text."""
    passes = slot_filter(names.select(F.explode(F.array(*_places(F.col("name")))).alias("key")), FLAGS)
    return lambda name: F.forall(F.array(*_places(name)), passes)


def fingerprint(text: Column, held) -> Column:
    """array<short> of one hash for each lexicon subset; 0 where none of its terms occurs. ``held`` is the test of :func:`in_lexicon`."""
    def window(level: int):
        shift = sum(e for e, _ in LEVELS if e < level)
        return lambda name: F.shiftrightunsigned(name, shift).bitwiseAND(F.lit((1 << level) - 1))

    def named(subset: Column) -> Column:
        value = F.greatest(F.xxhash64(subset).bitwiseAND(F.lit((1 << 15) - 1)), F.lit(1))
        return F.when(F.size(subset) == 0, F.lit(0)).otherwise(value).cast("short")

    def level_hashes(kept: Column, level: int, each: int) -> Column:
        at = window(level)
        pool = F.filter(kept, lambda x: at(x) < each)
        def one(p: Column, j: int) -> Column:
            return let(F.filter(p, lambda x: at(x) == j), named)

        return let(pool, lambda p: F.array(*(one(p, j) for j in range(each))))

    def hashes(kept: Column) -> Column:
        return F.flatten(F.array(*(level_hashes(kept, *level) for level in LEVELS)))

    def chosen(names: Column) -> Column:
        return let(F.filter(names, held), lambda inside: F.sort_array(F.when(F.size(inside) < LEAST, names).otherwise(inside)))

    return let(terms(text), lambda names: let(chosen(names), hashes))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets of which either text has a term; 1 where neither has any term."""
    both = F.zip_with(a, b, lambda x, y: F.when((x == 0) & (y == 0), F.lit(None)).otherwise((x == y).cast("int")))
    told = F.filter(both, lambda v: v.isNotNull())
    share = F.aggregate(told, F.lit(0), lambda total, v: total + v) / F.size(told)
    return F.when(F.size(told) == 0, F.lit(1.0)).otherwise(share)


def shown(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 4, "0"))), "")


def _slots(docs: DataFrame, slot_rows: int):
    """A column that puts rows into slots of about ``slot_rows``, ordered as descending doc_ids, null ones last.

    Ranges of doc_id come from quantiles, and are cut evenly into parts in very large tables. A doc_id that fills ranges of its own, or null, is
    divided by the hash of the text; only rows equal in both stay together. At most 1024 quantiles go to the driver.
    """
    rows, filled = docs.agg(F.count("*"), F.count("doc_id")).first()
    ranges = min(MOST_RANGES, max(1, filled // slot_rows))
    parts = min(MOST_PARTS, max(1, filled // (ranges * slot_rows)))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 20 * MOST_RANGES)).first()[0] if filled and ranges > 1 else []
    bounds = sorted(set(cuts))
    often = {b: (cuts.count(b) + 1) * parts for b in bounds if cuts.count(b) > 1}
    crowd = F.shiftright(F.xxhash64("text"), 40) + (1 << 23)  # rows of one slot of a doc_id are next to each other in the order of hashes

    def divided(n: int | Column) -> Column:
        return F.floor(crowd * n / F.lit(1 << 24)).cast("long")

    def numbered(r: Column, own: int, part: Column) -> Column:
        return F.shiftleft(r.cast("long"), 32) + F.lit(own << 31) + part

    lowest, highest = (docs.agg(F.min("doc_id"), F.max("doc_id")).first() if parts > 1 else (0, 0))
    edges = [lowest, *bounds, highest]
    listed = F.array(*map(F.lit, bounds)).cast("array<long>")
    above = F.size(F.filter(listed, lambda b: b > F.col("doc_id")))
    part = F.lit(0).cast("long")
    if parts > 1:
        upper, lower = (F.get(F.array(*(F.lit(e).cast("double") for e in edges)), F.lit(len(edges) - i) - above) for i in (1, 2))
        share = (upper - F.col("doc_id").cast("double")) / F.greatest(upper - lower, F.lit(1.0))
        part = F.greatest(F.lit(0), F.least(F.lit(parts - 1), F.floor(share * parts))).cast("long")
    slot = F.when(F.col("doc_id").isNull(), numbered(F.lit(len(bounds) + 1), 1, divided(max(1, (rows - filled) // slot_rows + 1))))
    for value, n in often.items():
        slot = slot.when(F.col("doc_id") == value, numbered(above, 1, divided(n)))
    return slot.otherwise(numbered(above, 0, part))


def _order() -> list[Column]:
    return [F.col("doc_id").isNull(), F.col("doc_id").desc(), F.xxhash64("text"), F.col("text")]


def with_next(docs: DataFrame, carried: dict[str, Column], slot_rows: int = SLOT_ROWS) -> DataFrame:
    """doc_id, text and the ``carried`` columns (expressions on text) of each row, and the same of the next row by descending doc_id as ``next_...``.

    After the last row comes the first; rows of one doc_id stand by hash of their text. Texts are shuffled once.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("slot", _slots(base, slot_rows))
    # The first row of each slot also ends the slot before. Slots are few: at most MOST_RANGES * MOST_PARTS.
    ends = sorted(base.groupBy("slot").agg(F.max("doc_id").alias("top")).collect())
    rows = [(slot, top, ends[i - 1][0]) for i, (slot, top) in enumerate(ends)]
    # Made from Arrow its size is known, so it is sent to the texts and not they to it.
    follows = docs.sparkSession.createDataFrame(pa.table([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["head_slot", "head_id", "ends"]))
    first = (
        base.join(follows, (F.col("slot") == F.col("head_slot")) & F.col("doc_id").eqNullSafe(F.col("head_id")))
        .groupBy(F.col("ends").alias("slot"), "doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text"))).alias("head"))
        .select("doc_id", F.col("head.text").alias("text"), "slot", F.lit(True).alias("guest"))
    )
    rows = base.withColumn("guest", F.lit(False)).unionByName(first).withColumns(carried)
    ordered = Window.partitionBy("slot").orderBy("guest", *_order())
    return rows.withColumns({f"next_{c}": F.lead(c).over(ordered) for c in ("text", *carried)}).where("not guest").drop("slot", "guest")


def edited(text: Column, following: Column) -> Column:
    """``text`` with the last floor(n / 2) characters replaced by the first as many (or all) of ``following``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every row.

    A null text is empty. A text without words has the fingerprint of no term, and is like others of that kind. Equal rows follow each other;
    null doc_ids come last; other columns are ignored; an empty table gives no rows.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    held = in_lexicon(lexicon(texts))
    rows = with_next(texts, {"hashes": fingerprint(F.col("text"), held)}, slot_rows)
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next_text"))).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"), "hashes", "next_hashes",
        fingerprint(F.col("edited"), held).alias("edited_hashes"))
    return rows.select("doc_id", "n_chars", "edited_sha256", shown(F.col("hashes")).alias("fingerprint"), shown(F.col("edited_hashes")).alias("edited_fingerprint"),
                       likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"), likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"))
