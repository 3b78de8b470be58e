"""Phrase mining by SON partitioning.

Texts are dealt into shards of one language each. Every shard is mined completely, in memory and level by level,
at the support that is its share of the wanted one: a phrase counted ``support`` times in all reaches
``ceil(support * share)`` in at least one shard. The locally frequent phrases are united;
a shard that does not report a phrase holds it less often than its local support, which
bounds the total, and phrases whose bound stays under the support go. A second pass over
all texts counts the others exactly, by their words.

A language has 12 shards, and more once they pass what a task's memory allows (``SHARD_CHARACTERS``). A language of more than
``support`` shards has a local support of 1: then the first pass passes on every phrase once a shard, and
the union's sums are the counts already. Hashes only name phrases between the passes; an accidental match
adds a candidate, never a count.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import shipped
from .common import LOWER, UPPER, release, stored

shipped(__name__)

LONGEST = 4
SUPPORT = 30
SHARDS = 12                   # of a language at least
SHARD_CHARACTERS = 48_000_000  # that a task mines at a time: larger languages have more shards
STEP = 1 << 18
RANGES = 3                    # bits of a name that tell in which round of a level it is counted
SLICE = 4_000_000             # bytes of text whose words are told apart at a time
BITS_LEAST, BITS_MOST = 15, 27  # of the filter of candidate hashes: 16 MB at most
UNKNOWN = "und"
BREAKS = ".,;:!?\x0a\x0b\x0c\x0d"
TABLE = bytes.maketrans((UPPER + BREAKS + "\t").encode(), (LOWER + "\n" * len(BREAKS) + " ").encode())


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of ``texts``, and the number in it and the piece of every word in order."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = data.slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes().translate(TABLE) if data is not None else b""
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(raw))
    pieces = pc.split_pattern(plain, "\n").flatten()
    split = pc.split_pattern(pieces, " ")
    sizes = np.diff(split.offsets.to_numpy())
    coded = split.flatten().dictionary_encode()
    distinct, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    filled = codes != (distinct.index("").as_py() if len(distinct) else -1)
    return distinct, codes[filled], np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[filled]


def sliced(texts: pa.Array):
    """``texts`` in parts of about ``SLICE`` bytes; a longer text is a part of its own."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) if len(texts) else np.zeros(0, np.int64)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE, "right")))
        yield texts.slice(at, to - at)
        at = to


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def named(distinct: pa.Array, lang: str) -> np.ndarray:
    """64-bit names of words; they differ from language to language."""
    own = pd.util.hash_array(np.array([lang], object))[0]
    return pd.util.hash_array(distinct.to_numpy(zero_copy_only=False).astype(object)) ^ own if len(distinct) else np.zeros(0, np.uint64)


def longer(name: np.ndarray, word: np.ndarray, size: int) -> np.ndarray:
    """Names of phrases of ``size`` words from those without their last word."""
    out = np.empty(len(word) - size + 1, np.uint64)
    for begin in range(0, len(out), STEP):  # bounded memory beside the result
        part = slice(begin, min(begin + STEP, len(out)))
        out[part] = _mixed(name[part] * np.uint64(0xD6E8FEB86659FD93) + word[part.start + size - 1:part.stop + size - 1])
    return out


def _frequent(name: np.ndarray, alive: np.ndarray, least: int):
    """Names at the places ``alive`` that occur ``least`` times or more there, their counts, and whether each place holds one."""
    kept = []
    for top in range(1 << RANGES):  # a range of names at a time: what is sorted and counted stays small
        own = np.concatenate([np.zeros(0, np.uint64), *(
            part[alive[begin:begin + STEP] & (part >> np.uint64(64 - RANGES) == top)]
            for begin in range(0, len(name), STEP) for part in [name[begin:begin + STEP]])])
        own.sort()
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
        counts = np.diff(np.r_[starts, len(own)])
        keep = counts >= least
        kept.append((own[starts[keep]], counts[keep]))
    found, counts = (np.concatenate([k[i] for k in kept]) for i in (0, 1))
    del kept, own, starts, keep
    held = np.zeros(len(alive), bool)
    for begin in range(0, len(name) if len(found) else 0, STEP):
        part = slice(begin, begin + STEP)
        at = np.minimum(np.searchsorted(found, name[part]), len(found) - 1)
        held[part] = alive[part] & (found[at] == name[part])
    return found, counts, held


def mine(word: np.ndarray, piece: np.ndarray, least: int, longest: int = LONGEST):
    """(names, counts) of all phrases of up to ``longest`` words counted ``least`` times or more, level by level."""
    name, alive = word, np.ones(len(word), bool)
    for size in range(1, longest + 1):
        if size > 1:
            if len(word) < size:
                return
            # A frequent phrase begins and ends with frequent ones that are a word shorter.
            alive = alive[:-1] & alive[1:] & (piece[:len(word) - size + 1] == piece[size - 1:])
            name = longer(name, word, size)
        found, counts, alive = _frequent(name, alive, least)
        yield found, counts


MINED = pa.schema([("lang", pa.string()), ("name", pa.int64()), ("excess", pa.int64()), ("allowed", pa.int64()), ("words", pa.int64())])


def _mined(support: int, longest: int, shard: int):
    def shard_rows(lang, total, held):
        size = sum(n for _, _, n in held)
        least = -(-support * size // total) if total else 1
        word = np.concatenate([w for w, _, _ in held])
        base, piece = 0, []
        for _, p, _ in held:
            piece.append(p + np.int32(base))
            base += int(p[-1]) + 1 if len(p) else 0
        piece = np.concatenate(piece)
        held.clear()
        least = max(1, least)
        for found, counts in mine(word, piece, least, longest):
            yield pa.RecordBatch.from_arrays([
                pa.array([lang], pa.string()).take(pa.array(np.zeros(len(found), np.int64))), pa.array(found.view(np.int64)),
                pa.array(counts - (least - 1)), pa.nulls(len(found), pa.int64()), pa.nulls(len(found), pa.int64())], schema=MINED)
        yield pa.RecordBatch.from_pylist([{"lang": lang, "name": None, "excess": None, "allowed": least - 1, "words": len(word)}], MINED)

    def run(batches):
        held, own, size, total = [], None, 0, 0
        for batch in batches:
            langs, parts, totals, texts = (batch.column(i) for i in range(4))
            keys = list(zip(langs.to_pylist(), parts.to_pylist()))
            sizes = np.cumsum([0] + pc.utf8_length(texts).to_pylist())
            at = 0
            while at < len(keys):
                if held and (keys[at] != own or size >= shard):
                    yield from shard_rows(own[0], total, held)
                    release()
                    size = 0
                own, total = keys[at], totals[at].as_py()
                to = at + 1
                while to < len(keys) and keys[to] == own and size + sizes[to] - sizes[at] < shard:
                    to += 1
                for part in sliced(texts.slice(at, to - at)):
                    distinct, codes, piece = words(part)
                    n = pc.sum(pc.utf8_length(part)).as_py()
                    held.append((named(distinct, own[0])[codes] if len(codes) else np.zeros(0, np.uint64), piece, n))
                    size += n
                at = to
        if held:
            yield from shard_rows(own[0], total, held)
        release()

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").alias("dealt_by"))


def mined(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shard: int = SHARD_CHARACTERS) -> DataFrame:
    """First pass: lang, name and excess (count above what an unreporting shard may hold) of each shard's frequent phrases; one row more a shard
    has the count it may hide (allowed) and its number of words."""
    texts = _texts(docs)
    # Stored, so that its size is known and the join with it needs no shuffle of texts.
    sizes = stored(texts.groupBy(F.col("lang").alias("of_lang")).agg(F.sum(F.length("text").cast("long")).alias("total")), "phrases-sizes")
    part = F.pmod(F.xxhash64("dealt_by", "text"), F.greatest(F.lit(SHARDS), F.ceil(F.col("total") / shard)))
    dealt = texts.join(sizes, F.col("lang") == F.col("of_lang")).select("lang", part.alias("part"), "total", "text")
    return dealt.repartition("lang", "part").sortWithinPartitions("lang", "part").mapInArrow(
        _mined(support, longest, shard), "lang string, name long, excess long, allowed long, words long")


def _filter(names: DataFrame) -> np.ndarray:
    """Bytes of a bit set in which both places of every name are set; its size is bounded, whatever the number of names."""
    bits = min(BITS_MOST, max(BITS_LEAST, (32 * names.count()).bit_length()))
    mask = (1 << bits) - 1
    places = names.select(F.explode(F.array(F.col("name").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("name", 32).bitwiseAND(F.lit(mask)))).alias("place"))
    at = F.col("place") + 1
    maps = places.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()  # at most 2^BITS_MOST / 32768 rows of 4 KB
    out = np.zeros((1 << bits) // 8, np.uint8)
    for row in maps:
        out[(row["bucket"] - 1) * 4096:row["bucket"] * 4096] = np.frombuffer(row["bits"], np.uint8)
    return out


def _passes(flags: np.ndarray, name: np.ndarray) -> np.ndarray:
    mask = np.uint64(len(flags) * 8 - 1)
    ok = np.ones(len(name), bool)
    for place in (name & mask, (name >> np.uint64(32)) & mask):
        ok &= (flags[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return ok


COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("n", pa.int64())])


def _counted(flags: np.ndarray, longest: int):
    def rows(lang, texts):
        distinct, codes, piece = words(texts)
        word = named(distinct, lang)[codes] if len(codes) else np.zeros(0, np.uint64)
        name = word
        for size in range(1, longest + 1):
            if len(word) < size:
                return
            if size > 1:
                name = longer(name, word, size)
            at = np.flatnonzero((piece[:len(name)] == piece[size - 1:]) & _passes(flags, name))
            # Phrases of one name are told apart by their words' numbers, so that counts are those of words.
            key = np.stack([codes[at + i] for i in range(size)])
            order = np.lexsort(key)
            key = key[:, order]
            first = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)]) if len(order) else np.zeros(0, np.int64)
            counts = np.diff(np.r_[first, len(order)])
            parts = [distinct.take(pa.array(k[first])) for k in key]
            phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if size > 1 else parts[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()).take(pa.array(np.zeros(len(first), np.int64))), phrase.cast(pa.string()),
                                              pa.array(np.full(len(first), size, np.int32)), pa.array(counts.astype(np.int64))], schema=COUNTED)

    def run(batches):
        for batch in batches:
            langs, texts = batch.column(0), batch.column(1)
            for lang in pc.unique(langs).to_pylist():
                for part in sliced(texts.filter(pc.equal(langs, lang))):
                    yield from rows(lang, part)
        release()

    return run


def frequent(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shard: int = SHARD_CHARACTERS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, a) of every phrase of up to ``longest`` words that occurs ``support`` times or more, and (lang, n) of all words."""
    local = stored(mined(docs, support, longest, shard), "phrases-mined")
    shards = local.where("name is null").groupBy("lang").agg(F.sum("allowed").alias("hidden"), F.sum("words").alias("n"))
    united = local.where("name is not null").groupBy("lang", "name").agg(F.sum("excess").alias("excess"))
    hidden = shards.select(F.col("lang").alias("of_lang"), "hidden")
    candidates = stored(united.join(hidden, F.col("lang") == F.col("of_lang")).where(F.col("excess") + F.col("hidden") >= support).select("name"), "phrases-candidates")
    counted = _texts(docs).select("lang", "text").mapInArrow(_counted(_filter(candidates), longest), "lang string, phrase string, size int, n long")
    found = counted.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("a")).where(F.col("a") >= support)
    return stored(found, "phrases-frequent"), shards.select("lang", "n")


def collocations(docs: DataFrame, top: int = 2000, support: int = SUPPORT, longest: int = LONGEST, shard: int = SHARD_CHARACTERS) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n and score.

    A phrase of two or more words is scored by its worst cut into two parts, floor(2000000 * a / (l + r)); phrases that a
    longer one with 80 % of their count holds are left out. Ties go to the smaller cut, then to the greater count, then to the phrase's
    bytes. A null text is empty, a null language ``und``; repeated rows and null or repeated doc_ids count as rows; other columns are ignored.
    """
    found, totals = frequent(docs, support, longest, shard)
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    split = F.split("phrase", " ")
    joined = lambda begin, length: F.array_join(F.slice(split, begin, length), " ")
    cut = found.where("size > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("head"), joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    left = found.select(F.col("lang").alias("l_lang"), F.col("phrase").alias("head_is"), F.col("a").alias("l"))
    right = found.select(F.col("lang").alias("r_lang"), F.col("phrase").alias("tail_is"), F.col("a").alias("r"))
    cut = cut.join(left, (F.col("lang") == F.col("l_lang")) & (F.col("head") == F.col("head_is"))).join(
        right, (F.col("lang") == F.col("r_lang")) & (F.col("tail") == F.col("tail_is")))
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))").alias("score")
    worst = cut.select("lang", "phrase", "a", F.struct(score, "k", "l", "r").alias("cut")).groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut"))

    places = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), b -> struct(b, m))))")
    inside = found.where("size > 2").withColumn("at", F.explode(places)).select(
        F.col("lang").alias("h_lang"), joined(F.col("at.b"), F.col("at.m")).alias("held"), "a").groupBy("h_lang", "held").agg(F.max("a").alias("most"))
    kept = worst.join(inside, (F.col("lang") == F.col("h_lang")) & (F.col("phrase") == F.col("held")), "left").where(
        F.col("most").isNull() | (100 * exact("most") < 80 * exact("a")))
    totals = totals.select(F.col("lang").alias("n_lang"), "n")
    ranked = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn(
        "rank", F.expr("row_number() over (partition by lang order by score desc, a desc, phrase)")).where(F.col("rank") <= top)
    return ranked.join(totals, F.col("lang") == F.col("n_lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = """
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM texts),
split AS (SELECT lang, list_filter(string_split_regex(p, '[ \\t]+'), lambda x: x <> '') AS ws FROM pieces),
totals AS (SELECT lang, sum(len(ws)) AS n FROM split GROUP BY lang),
grams AS (SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda b: array_to_string(ws[b:b + size - 1], ' '))) AS phrase
          FROM split, range(1, 5) AS sizes(size) WHERE len(ws) >= size),
found AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY lang, size, phrase HAVING count(*) >= 30),
cuts AS (SELECT lang, phrase, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head, array_to_string(string_split(phrase, ' ')[k + 1:size], ' ') AS tail
         FROM found, range(1, 4) AS cut(k) WHERE k < size),
scored AS (SELECT c.lang, c.phrase, c.a, k, h.a AS l, t.a AS r, (2000000::HUGEINT * c.a) // (h.a + t.a) AS score
           FROM cuts c JOIN found h ON h.lang = c.lang AND h.phrase = c.head JOIN found t ON t.lang = c.lang AND t.phrase = c.tail),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT f.lang, array_to_string(string_split(f.phrase, ' ')[b:b + m - 1], ' ') AS held, max(f.a) AS most
           FROM found f, range(2, 4) AS sizes(m), range(1, 4) AS begins(b) WHERE m < f.size AND b + m - 1 <= f.size GROUP BY 1, 2),
kept AS (SELECT w.* FROM worst w LEFT JOIN inside i ON i.lang = w.lang AND i.held = w.phrase WHERE i.most IS NULL OR 100 * i.most < 80 * w.a)
SELECT k.lang, CAST(row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank, phrase, CAST(a AS BIGINT) AS a,
       CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept k JOIN totals t ON t.lang = k.lang QUALIFY row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
