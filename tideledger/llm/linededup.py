"""Near-equal lines: a segment-partition edit join.

Two lines within ``distance`` edits (insert, delete, change one character) share at
least one of the distance + 1 even segments of the shorter one, at a place shifted
by no more than the edits to its left and right allow. Lines index their segments by
(length, segment number, content) and probe the substrings that such a
segment of a line of each admissible length could be (the multi-match-aware
selection). Candidates must also agree in the parities of their letters' numbers, of which
one edit flips two at most; the rest is verified with the banded edit distance
on the texts.

Texts stay where they are until they meet under a key. Keys are first counted down to those under
which different lines meet (equal lines combine before the shuffle), then only line numbers of 64 bits move
under those keys, and each line that met another is fetched once for its parities and the verification. Under one key
every two lines are compared by their parities only while at most ``CROWD`` of them index or probe it. The lines of
a more crowded key meet under finer ones instead, which hold all but ``distance`` of three times as many segments, and
again with what these leave, until a key is not crowded or leaves no more than ``distance`` characters. So comparisons grow with the
number of lines, except between lines that are alike in all but ``distance`` characters at the same places, which are results.

Lines too short for distance + 1 segments are all within the distance of each other: they are one group, counted and
hung on its least member without pairs. They meet longer lines through what is left after up to ``distance`` deletions.
"""

from __future__ import annotations

import functools
import itertools

from pyspark.sql import Column, DataFrame, functions as F

from .common import packed, passing, stored, text_key
from .components import components

DISTANCE = 2
SHORT = 30  # shorter lines only count as repeated when they are equal; op8 asks for every length
CROWD = 32  # indexed lines, or probes, compared with all others under one key
LATIN = "abcdefghijklmnopqrstuvwxyz"
CYRILLIC = "".join(map(chr, range(0x430, 0x450)))


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no (from 0) and line of every line of every text, blanks at both ends removed; a null text has none."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn(
        "line", F.trim(F.col("line")))


def _parity(line: Column) -> Column:
    """One bit per letter: whether the line holds it an odd number of times.

    An edit changes the counts of two letters at most, so a pair within ``distance`` edits
    differs in twice as many bits at most. Cyrillic letters share the bits above the Latin ones.
    """
    def odd(letters: str, first: int) -> list[Column]:
        size = F.octet_length(line)
        return [F.shiftleft(((size - F.octet_length(F.replace(line, F.lit(c), F.lit("")))) / len(c.encode())).cast("long")
                            .bitwiseAND(F.lit(1).cast("long")), first + i) for i, c in enumerate(letters)]

    latin = functools.reduce(Column.bitwiseOR, odd(LATIN, 0))
    other = functools.reduce(Column.bitwiseOR, odd(CYRILLIC, len(LATIN)))
    return F.when(F.length(line) == F.octet_length(line), latin).otherwise(latin.bitwiseOR(other))


def _places(distance: int) -> Column:
    """(probes, less, part, shift): whose segments to take; a probe looks for lines of its own length or up to ``distance`` shorter."""
    parts = distance + 1
    made = [(False, 0, i, 0) for i in range(1, parts + 1)]
    for less in range(distance + 1):
        for i in range(1, parts + 1):
            low, high = max(1 - i, less - (parts - i)), min(i - 1, less + (parts - i))
            made += [(True, less, i, shift) for shift in range(low, high + 1)]
    return F.array(*(F.struct(*(F.lit(v).alias(name) for v, name in zip(place, ("probes", "less", "part", "shift")))) for place in made))


def _keys(every: DataFrame, distance: int) -> DataFrame:
    """line, id, h and probes: each key of each line. The last segments of a line take the remainder of its length."""
    parts, length = distance + 1, F.col("size") - F.col("less")
    first_long = parts - length % parts + 1
    placed = every.select("line", "size", F.xxhash64("line").alias("id"), F.explode(_places(distance)).alias("p")).select(
        "line", "size", "id", "p.*").withColumn("length", length).withColumn("base", F.floor(length / parts).cast("int")).withColumn(
        "first_long", first_long)
    cut = placed.withColumn("at", F.col("base") * (F.col("part") - 1) + F.greatest(F.col("part") - F.col("first_long"), F.lit(0)) + F.col("shift")).withColumn(
        "width", F.col("base") + (F.col("part") >= F.col("first_long")).cast("int"))
    inside = (F.col("at") >= 0) & (F.col("at") + F.col("width") <= F.col("size")) & (F.col("base") > 0)
    return cut.where(inside).select("line", "id", F.xxhash64("length", "part", F.expr("substring(line, at + 1, width)")).alias("h"), "probes")


def _met(keys: DataFrame, label: str) -> DataFrame:
    """The rows of ``keys`` (h, probes, id and what else it has) under whose key an indexed line meets a probe of a different one, stored."""
    # Each key is one row however many lines share it.
    shared = stored(
        keys.groupBy("h").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.bit_or(F.when(F.col("probes"), 1).otherwise(2)).alias("kinds"))
        .where("least < most and kinds = 3").select(F.col("h").alias("key")), f"{label}-keys")
    return stored(passing(keys, "h", shared).join(shared, F.col("h") == F.col("key")).select(*keys.columns).distinct(), f"{label}-met")


def _crowded(met: DataFrame, label: str, where: str = "true") -> DataFrame:
    """key: those under which more than ``CROWD`` indexed lines meet more than ``CROWD`` probes, stored."""
    counts = met.where(where).groupBy("h").agg(F.count_if("probes").alias("probing"), F.count_if(~F.col("probes")).alias("indexed"))
    return stored(counts.where(F.least("probing", "indexed") > CROWD).select(F.col("h").alias("key")), f"{label}-crowded")


def _refined(rows: DataFrame, distance: int) -> DataFrame:
    """Finer keys of ``rows`` (h, probes, id, n, left), in the same columns.

    ``left`` is what the key h leaves of a line to compare, n its length in an indexed line. It is cut into three times
    ``distance`` even segments, of which as many edits touch ``distance`` at most: all others are equal, shifted by
    what the touched ones before them grew by. Each choice of the touched ones is a key of all the others, and they are what is left.
    """
    parts, probes, left = 3 * distance, F.col("probes"), F.col("left")

    def table(rows: list[tuple], names: list[str]) -> Column:
        return F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row))) for row in rows))

    touched = table(list(itertools.combinations(range(parts), distance)), [f"k{t}" for t in range(distance)])
    growth = [e for e in itertools.product(range(-distance, distance + 1), repeat=distance) if sum(map(abs, e)) <= distance]
    grown = table([(sum(e), sum(map(abs, e)), *e) for e in growth], ["all", "edits", *(f"e{t}" for t in range(distance))])
    fitting = F.filter(grown, lambda g: F.when(probes, g["all"] == F.length(left) - F.col("n")).otherwise(g["edits"] == 0))
    ways = rows.select("h", "probes", "id", "n", "left", F.explode(touched).alias("k")).select("*", F.explode(fitting).alias("e"))

    def edge(segment: Column) -> Column:
        return F.floor(segment * F.col("n") / parts).cast("int")

    def cut(start: Column, end: Column) -> Column:
        return F.substring(left, start + 1, end - start)

    at = moved = n = F.lit(0)
    equal, kept, fits = [], [], F.lit(True)
    for t in range(distance):
        k, e = F.col(f"k.k{t}"), F.col(f"e.e{t}")
        first, last = edge(k) + moved, edge(k + 1) + moved + e
        equal.append(cut(at, first))
        kept.append(cut(first, last))
        fits, n = fits & (last >= first), n + edge(k + 1) - edge(k)
        at, moved = last, moved + e
    equal.append(cut(at, F.length(left)))
    key = F.xxhash64("h", "n", *(F.col(f"k.k{t}") for t in range(distance)), *equal)
    return ways.where(fits).select(key.alias("h"), "probes", "id", n.alias("n"), F.concat(*kept).alias("left"))


def _finer(lines_met: DataFrame, distance: int) -> DataFrame:
    """Rows (h, probes, id, left) by which lines (id, line) within the distance meet under keys that are not crowded.

    Keys are refined while they are crowded. Those that leave no more than ``distance`` characters stay as they are: their lines differ in these only.
    """
    size = F.length("line")
    less = F.explode(F.sequence(F.lit(-1), F.lit(distance))).alias("less")  # -1: the indexed line itself
    rows = lines_met.select("id", "line", less).select(
        F.lit(0).cast("long").alias("h"), (F.col("less") >= 0).alias("probes"), "id", (size - F.greatest("less", F.lit(0))).alias("n"), F.col("line").alias("left")).where(F.col("n") > distance)
    found = []
    while True:
        met = _met(_refined(rows, distance), "line-finer")
        crowded = _crowded(met, "line-finer", f"n > {distance}")
        if crowded.isEmpty():
            return functools.reduce(DataFrame.unionByName, found, met)
        found.append(met.join(crowded, F.col("h") == F.col("key"), "left_anti"))
        rows = met.join(crowded, F.col("h") == F.col("key"), "left_semi")


def _candidates(every: DataFrame, distance: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (low, high) of ids of different lines that share a key and nearly agree in their letters' parities; id and line of all that share one."""
    met = _met(_keys(every, distance).select("h", "probes", "id"), "line")
    ids = met.select(F.col("id").alias("key")).distinct()
    texts = stored(
        passing(every.select("line", F.xxhash64("line").alias("id")), "id", ids).distinct().join(ids, F.col("id") == F.col("key"))
        .select("id", "line", _parity(F.col("line")).alias("parity")), "line-texts")
    crowded = _crowded(met, "line")
    x, y = F.col("a.id"), F.col("b.id")
    near = F.bit_count(F.col("a.parity").bitwiseXOR(F.col("b.parity"))) <= 2 * distance

    def pairs(met: DataFrame, alike: Column) -> DataFrame:
        met = met.join(texts.select("id", "parity"), "id")
        return met.where("not probes").alias("a").join(met.where("probes").alias("b"), (F.col("a.h") == F.col("b.h")) & (x != y) & alike).select(
            F.least(x, y).alias("low"), F.greatest(x, y).alias("high"))

    if crowded.isEmpty():
        found = pairs(met, near)
    else:
        many = met.join(crowded, F.col("h") == F.col("key"), "left_semi").select(F.col("id").alias("key")).distinct()
        finer = _finer(texts.join(many, F.col("id") == F.col("key")).select("id", "line"), distance)
        found = pairs(met.join(crowded, F.col("h") == F.col("key"), "left_anti"), near).unionByName(
            pairs(finer, near & (F.levenshtein("a.left", "b.left", distance) >= 0)))
    return stored(found.distinct(), "line-pairs"), texts


def _shortened(line: Column, distance: int) -> Column:
    """What is left of a line after up to ``distance`` deletions, without the empty string."""
    def once(kept: Column) -> Column:
        return F.flatten(F.transform(kept, lambda s: F.transform(
            F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))))))

    level = made = F.array(line)
    for _ in range(distance):
        level = F.filter(F.array_distinct(once(level)), lambda s: s != "")
        made = F.array_union(made, level)
    return made


def _brief_links(every: DataFrame, distance: int) -> DataFrame:
    """Pairs (x, y) of a line of at most ``distance`` characters and a longer one within the distance."""
    kept = every.where(F.col("size") <= 2 * distance).select("line", "size").distinct()
    left = kept.select("line", "size", F.explode(_shortened(F.col("line"), distance)).alias("left"))
    tiny = left.where(F.col("size") <= distance).select(F.col("line").alias("x"), "left")
    longer = left.where(F.col("size") > distance).select(F.col("line").alias("y"), "left")
    return tiny.join(longer, "left").where(F.levenshtein("x", "y", distance) >= 0).select("x", "y")


def links(docs: DataFrame, distance: int = DISTANCE, short: int = SHORT) -> DataFrame:
    """Pairs (a, b) of keys of different lines within ``distance`` edits, both ``short`` characters long or longer.

    Pairs of two lines of at most ``distance`` characters are left out: all of them are within the distance (:func:`tiny_lines`).
    """
    every = lines(docs).select("line", F.length("line").alias("size")).where(F.col("size") >= max(short, 1))
    cut = every.where(F.col("size") > distance)
    found, texts = _candidates(cut, distance)
    both = found.join(texts.select(F.col("id").alias("low"), F.col("line").alias("x")), "low").join(
        texts.select(F.col("id").alias("high"), F.col("line").alias("y")), "high").where(F.levenshtein("x", "y", distance) >= 0).select("x", "y")
    if short <= distance:
        both = both.unionByName(_brief_links(every, distance))
    x, y = F.col("x"), F.col("y")
    return both.select(text_key(F.least(x, y)).alias("a"), text_key(F.greatest(x, y)).alias("b")).distinct()


def tiny_lines(docs: DataFrame, distance: int, short: int) -> DataFrame:
    """key of each different line of ``short`` to ``distance`` characters: every two of them are within the distance."""
    return lines(docs).where(F.length("line").between(max(short, 1), distance)).select(text_key(F.col("line")).alias("key")).distinct()


def graph(docs: DataFrame, distance: int, short: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that connect each class, stored, and (node, links): the number of other lines within the distance."""
    found = stored(links(docs, distance, short), "line-links")
    degree = found.select(F.col("a").alias("node"), F.lit(1).alias("n")).unionAll(found.select(F.col("b").alias("node"), F.lit(1).alias("n")))
    if short <= distance:
        tiny = stored(tiny_lines(docs, distance, short), "tiny-lines")
        all_of = tiny.agg(F.min("key").alias("least"), F.count("*").alias("n")).first()
        if all_of["n"] > 1:
            least = F.lit(bytes(all_of["least"]))
            found = found.unionAll(tiny.where(F.col("key") != least).select(least.alias("a"), F.col("key").alias("b")))
            degree = degree.unionAll(tiny.select("key", F.lit(all_of["n"] - 1).cast("int")))
    return found, degree.groupBy("node").agg(F.sum("n").alias("links"))


def classes(docs: DataFrame, distance: int = DISTANCE, short: int = SHORT) -> DataFrame:
    """doc_id, line_no, line_class (hex) and links of every line that is not blank.

    Equal lines share a class, and so do lines joined by a chain of
    edits within the distance; ``links`` counts the different other lines within it.
    Null and empty texts have no lines; repeated or null doc_ids keep their lines; other columns are ignored.
    """
    found, degree = graph(docs, distance, short)
    named = components(found).join(degree, "node")
    at = lines(docs).where("line != ''").select("doc_id", "line_no", text_key(F.col("line")).alias("key"))
    return at.join(named, at["key"] == named["node"], "left").select(
        "doc_id", "line_no", F.lower(F.hex(F.coalesce("component", "key"))).alias("line_class"),
        F.coalesce("links", F.lit(0)).alias("links"))


def without_repeats(docs: DataFrame, distance: int = DISTANCE, short: int = SHORT, shortest: int | None = None) -> DataFrame:
    """``docs`` with each class of lines of ``shortest`` characters or more (``short``, if not given) kept at its first place only.

    First means the least (doc_id, text key, line number), null doc_ids last; rows keep their number and columns, text and n_chars
    follow the lines that stay. Lines under ``short`` characters only repeat equal ones; those under ``shortest`` always stay. Equal rows (same doc_id and text) lose and keep the same lines.
    """
    named = components(graph(docs, distance, short)[0])
    rows = docs.select("doc_id", "text")
    long = rows.select("doc_id", text_key(F.col("text")).alias("doc"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn(
        "line", F.trim("line")).where(F.length("line") >= (short if shortest is None else shortest)).select("doc_id", "doc", "line_no", text_key(F.col("line")).alias("key"))
    placed = stored(long.join(named, long["key"] == named["node"], "left").select(
        "doc_id", "doc", "line_no", F.coalesce("component", "key").alias("class")), "line-places")
    place = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("doc"), F.col("line_no"))
    first = placed.groupBy("class").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("class", "first")
    repeats = (
        placed.join(first, "class").where(~place.eqNullSafe(F.col("first")))
        .groupBy("doc_id", "doc").agg(F.collect_set("line_no").alias("drop")).withColumnRenamed("doc_id", "drop_id")
    )
    keyed = packed(docs).withColumn("own_doc", text_key(F.col("row.text")))
    joined = keyed.join(repeats, (F.col("own_doc") == F.col("doc")) & F.col("row.doc_id").eqNullSafe(F.col("drop_id")), "left")
    text = F.col("row.text")
    kept = F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains("drop", i))
    changed = joined.withColumn("new_text", F.when(F.col("drop").isNull(), text).otherwise(F.array_join(kept, "\n")))
    made = {"text": F.col("new_text").alias("text"), "n_chars": F.length("new_text").cast("long").alias("n_chars")}
    return changed.select(*(made.get(c, F.col("row").getField(c).alias(c)) for c in docs.columns))
