"""Packing token sequences by bulk-synchronous best fit.

Documents become tokens in tasks and are range-ranked by length on the cluster:
every piece gets its rank among the pieces of its length. Pieces of one length are
interchangeable, and so are open sequences with one gap; the sweep therefore moves
runs (a length with ranks from..to; a gap with sequence numbers from..to) instead of rows.
From the longest length down, each step is one bulk round: all pieces of the length,
wherever they lie, go at once to their successors (the smallest gaps that hold
them), conflicts are settled by rank, the gaps shrink, and the next length follows. A
run table has at most one length per token of the limit and two more gap runs
per step, whatever the corpus, so the plan is small, and rows read their place from
it by rank. The result is best-fit decreasing over all pieces.
"""

from __future__ import annotations

import bisect
import functools
import os
import re
import zlib

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import shipped
from .common import kept, release, stored

shipped(__name__)

LIMIT = 2048
END = b"\0\0\0\0"  # id 0 closes each document
BUCKETS = 256
CACHED = 400_000   # words and units whose ids a worker remembers
SLICE = 1_000_000  # bytes of text encoded at a time
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


# Characters whose class and lower case no Unicode version changes and that NFC leaves alone,
# and the rule by which the tokenizer's file cuts a text in lower case.
PLAIN = r"[ \n\r\t!-~¡-±´-¸º»¿-ɏЀ-џぁ-ゖァ-ヺ一-龥가-힣]*"
CUT = r"[^\W\d_]+|\d|'(?:[stmd]|re|ve|ll)|(?:[^\w\s]|_)+"


class PieceIds:
    """Ids of whole texts.

    The words of a text of plain characters are cut into the tokenizer's own units; both are
    encoded once and remembered. A text with any other character, or with a part that looks like a special token, goes
    through the tokenizer as it is, which is loaded when the first such text comes.
    """

    def __init__(self, tokenizer_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.whole = functools.cache(lambda: Tokenizer.from_file(tokenizer_file))
        self.units = Tokenizer.from_file(tokenizer_file)
        self.units.normalizer = None
        self.units.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain, self.cut = re.compile(PLAIN).fullmatch, re.compile(CUT).findall
        self.known: dict[str, bytes] = {}  # units, and words, of which a unit is one

    def _learn(self, missing: list[str]) -> None:
        for at in range(0, len(missing), 4096):
            part = missing[at:at + 4096]
            found = self.units.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, "<u4").tobytes()
            ends = (4 * np.searchsorted(np.array(found.word_ids), np.arange(len(part) + 1))).tolist()
            self.known.update(zip(part, map(ids.__getitem__, map(slice, ends, ends[1:]))))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [t.lower().split() if "<|" not in t and self.plain(t) else None for t in texts]
        if len(self.known) > CACHED:
            self.known.clear()
        known = self.known
        new = set().union(*filter(None, split)).difference(known)
        alone = {w for w in new if w.isalpha()}  # one unit, whatever its letters
        cuts = {w: self.cut(w) for w in new.difference(alone)}
        self._learn(list(alone.union(*cuts.values()).difference(known)))
        known.update((w, b"".join(map(known.__getitem__, units))) for w, units in cuts.items() if w not in known)
        return [np.array(self.whole().encode(t, add_special_tokens=False).ids, "<u4").tobytes() if part is None
                else b"".join(map(known.__getitem__, part)) for t, part in zip(texts, split)]


def encoder(tokenizer_file: str) -> PieceIds:
    """The encoder of this process: a worker that runs several tasks of this step keeps what it has learnt."""
    return kept(tokenizer_file, lambda: PieceIds(tokenizer_file))


def pieces(docs: DataFrame, tokenizer_file: str, limit: int = LIMIT) -> DataFrame:
    """Pieces of at most ``limit`` ids of each document's ids with the closing id; a null text counts as empty."""
    def run(batches):
        import pyarrow as pa

        ids_of = encoder(tokenizer_file).encode
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        for batch in batches:
            ids_of_docs, texts = batch.column(0), batch.column(1)
            sizes = [n or 0 for n in pc.binary_length(texts).to_pylist()]
            # Slices of a bounded number of bytes, made Python strings one slice at a time, so that memory does not follow the batch.
            at = 0
            while at < len(texts):
                stop, held = at, 0
                while stop < len(texts) and (stop == at or held + sizes[stop] <= SLICE):
                    held += sizes[stop]
                    stop += 1
                made: list[list] = [[] for _ in types]
                for doc_id, ids in zip(ids_of_docs.slice(at, stop - at).to_pylist(), ids_of([t or "" for t in texts.slice(at, stop - at).to_pylist()])):
                    ids += END
                    for k, start in enumerate(range(0, len(ids), 4 * limit)):
                        part = ids[start:start + 4 * limit]
                        for column, value in zip(made, (doc_id, k, start // 4, len(part) // 4, zlib.crc32(part))):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(made, types)], names=["doc_id", "piece", "start", "length", "ids_crc32"])
                at = stop
        release(keep=tokenizer_file)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECE)


def ranks(made: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``rank`` of each piece among those of its length, from 0.

    Numbers run inside (length, bucket) and the buckets' counts add up to their
    starts, so a length that a third of all pieces have is not one task's work.
    """
    dealt = made.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    starts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n")).withColumn(
        "before", F.expr("sum(n) over (partition by length order by bucket) - n")).drop("n")
    return dealt.withColumn("at", F.expr("row_number() over (partition by length, bucket order by doc_id, piece) - 1")).join(
        starts, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("at")).drop("bucket", "before", "at")


def best_fit(lengths: dict[int, int], limit: int = LIMIT) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over runs: (length, first rank, count, first sequence, offset) per placed run."""
    gaps: list[tuple[int, int, int]] = []  # sorted: gap, first sequence, count
    plan, opened = [], 0
    for length in sorted(lengths, reverse=True):
        left, rank = lengths[length], 0

        def fill(gap: int, first: int, count: int, each: int) -> None:
            """``each`` pieces into every one of ``count`` sequences with this gap."""
            nonlocal rank, left
            for layer in range(each):
                plan.append((length, rank, count, first, limit - gap + layer * length))
                rank += count
            left -= count * each
            if gap > each * length:
                bisect.insort(gaps, (gap - each * length, first, count))

        while left:
            at = bisect.bisect_left(gaps, (length,))
            if at < len(gaps):
                gap, first, count = gaps.pop(at)
            else:
                gap, first = limit, opened
                count = -(-left // (limit // length))
                opened += count
            each = gap // length
            full = min(count, left // each)
            if full:
                fill(gap, first, full, each)
            if full < count:
                rest = min(left, each)  # under each, so one sequence takes it
                if rest:
                    fill(gap, first + full, 1, rest)
                    full += 1
                if full < count:
                    bisect.insort(gaps, (gap, first + full, count - full))
    return plan


def pack(docs: DataFrame, tokenizer_file: str, limit: int = LIMIT) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text counts as empty and takes one id; rows with repeated or null doc_ids are packed each on its own;
    an empty table gives no rows; other columns are ignored.
    """
    made = stored(pieces(docs, tokenizer_file, limit), "pieces")
    counts = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most limit rows
    plan = np.array(best_fit(counts, limit), np.int64).reshape(-1, 5)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    span = int(max(counts.values(), default=0)) + 1
    keys = plan[:, 0] * span + plan[:, 1]  # length and rank as one number

    def run(batches):
        for batch in batches:
            at = np.searchsorted(keys, batch["length"].to_numpy() * span + batch["rank"].to_numpy(), side="right") - 1
            batch["sequence_id"] = plan[at, 3] + batch["rank"].to_numpy() - plan[at, 1]
            batch["offset"] = plan[at, 4]
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            yield batch.drop(columns="rank")

    return ranks(made).select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInPandas(
        run, PIECE + ", sequence_id long, offset long")
