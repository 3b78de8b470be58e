"""Benchmark decontamination: a prefix-filtered set join with exact verification.

A window is ``window`` consecutive words of a benchmark item (a shorter item is
one window). Its tokens are its shingles of up to three words. Tokens are ordered
by rarity among the documents; as a window must be contained whole, its necessary
prefix is one token, the rarest. Documents probe with their own shingles: a slot
filter drops the positions that cannot match, the rest join the prefix index on the
shingle's hash. The position bound fixes where the window must start, the length
bound requires the words around it to exist, and the words themselves decide.

The words a candidate needs travel with it (window - 1 to each side at most), so texts are
neither shuffled nor read again for the check, and a frequent passage meets the
index only through the one token of each of its windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import let, lower_ascii, packed, slot_filter, stored, text_key

SHINGLE = 3
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SLOT_BITS = 17
OCCURRENCE = "doc binary, item_id bigint, start int, size int"


def words(text: Column) -> Column:
    """Lower-cased (A-Z) runs of letters, digits and characters beyond ASCII; a null text has none."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def _shingles(w: Column, k: int) -> Column:
    """The k-word shingles of ``w``: hash ``key`` and position ``at``."""
    made = F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.struct(
        F.xxhash64(F.lit(k), *(F.get(w, i + j) for j in range(k))).alias("key"), i.alias("at")))
    return F.when(F.size(w) >= k, made).otherwise(F.array().cast("array<struct<key:bigint,at:int>>"))


def windows(items: DataFrame, window: int) -> DataFrame:
    """Windows of the items: item_id, words; items without words have none."""
    cut = let(words(F.col("text")), lambda w: F.when(F.size(w) > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - window, F.lit(0))), lambda i: F.slice(w, i + 1, F.lit(window)))))
    return items.select("item_id", F.explode_outer(cut).alias("w")).where("w is not null").distinct()


def _probes(docs: DataFrame, sizes: list[int], passes, reach: int) -> DataFrame:
    """Positions whose shingle passes the filter, with the words around them: doc, key, at, head, near.

    ``head`` counts the words that ``near`` holds before the position.
    """
    def near(w: Column, k: int) -> Column:
        return F.transform(F.filter(_shingles(w, k), lambda x: passes(x["key"])), lambda x: F.struct(
            x["key"].alias("key"), x["at"].alias("at"), F.least(x["at"], F.lit(reach)).alias("head"),
            F.slice(w, F.greatest(x["at"] - reach, F.lit(0)) + 1, F.least(x["at"], F.lit(reach)) + reach + k).alias("near")))

    found = let(words(F.col("text")), lambda w: F.concat(*(near(w, k) for k in sizes)))
    return (
        docs.select(text_key(F.col("text")).alias("doc"), F.explode_outer(found).alias("x"))
        .where("x is not null").select("doc", "x.*")
    )


def occurrences(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """Where windows occur: doc (text key), item_id, start, size, all distinct.

    docs: text; items: item_id, text. Rows with the same text give one result.
    """
    spark = docs.sparkSession
    wins = stored(windows(items, window).withColumn("k", F.least(F.size("w"), F.lit(SHINGLE))), "windows")
    sizes = [r["k"] for r in wins.select("k").distinct().collect()]  # 1 to 3
    if not sizes:
        return spark.createDataFrame([], OCCURRENCE)
    own = F.coalesce(*(F.when(F.col("k") == k, _shingles(F.col("w"), k)) for k in sizes))
    spread = stored(wins.select("item_id", "w", F.explode(own).alias("x")).select("item_id", "w", "x.key", "x.at"), "tokens")

    # Rarity: how often each of the benchmark's shingles occurs in the documents.
    in_benchmark = slot_filter(spread.select("key"), SLOT_BITS)
    seen = let(words(F.col("text")), lambda w: F.transform(F.filter(
        F.concat(*(_shingles(w, k) for k in sizes)), lambda x: in_benchmark(x["key"])), lambda x: x["key"]))
    rarity = docs.select(F.explode_outer(seen).alias("key")).where("key is not null").groupBy("key").agg(F.count("*").alias("n"))

    # The rarest token of each window; a token no document holds rules its window out.
    ranked = (
        spread.join(rarity, "key", "left")
        .groupBy("item_id", "w")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("at"), F.col("key"))).alias("rarest"))
        .where("rarest.n > 0")
        .select("item_id", "w", F.col("rarest.at").alias("offset"), F.col("rarest.key").alias("key"))
    )
    # Windows of equal words share one entry; their items follow at the end.
    index = stored(ranked.groupBy("key", "w", "offset").agg(F.collect_set("item_id").alias("item_ids")), "prefix-index")
    if index.isEmpty():
        return spark.createDataFrame([], OCCURRENCE)
    probes = _probes(docs, sizes, slot_filter(index.select("key"), SLOT_BITS), window - 1)
    met = probes.join(index, "key").where(
        (F.col("at") >= F.col("offset"))  # position bound
        & (F.slice("near", F.col("head") - F.col("offset") + 1, F.size("w")) == F.col("w"))  # length and words
    )
    return (
        met.select("doc", F.explode("item_ids").alias("item_id"), (F.col("at") - F.col("offset")).alias("start"),
                   F.size("w").alias("size"))
        .distinct()
    )


def report(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words; rows with a repeated or null doc_id are
    reported each on its own; null or empty items match nothing; an item_id may
    come with several texts. Columns of ``docs`` other than doc_id and text are ignored.
    """
    docs = docs.select("doc_id", "text")
    hits = stored(occurrences(docs, items, window), "window-hits")
    # Words inside any occurrence: the length of the union of the intervals, in order of their start.
    ends = hits.groupBy("doc", "start").agg(F.max(F.col("start") + F.col("size")).alias("stop"))
    covered = (
        ends.withColumn("reached", F.expr(
            "max(stop) over (partition by doc order by start rows between unbounded preceding and 1 preceding)"))
        .groupBy("doc").agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest(
            F.col("start"), F.coalesce("reached", F.lit(0))))).cast("long").alias("n_hit"))
    )
    found = hits.select("doc", F.col("item_id").cast("string").alias("item_id")).distinct().groupBy("doc").agg(
        F.count("*").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.collect_list("item_id")), ","), 256).alias("items_sha256"))
    summary = covered.join(found, "doc").withColumnRenamed("doc", "key")
    return (
        docs.select("doc_id", text_key(F.col("text")).alias("key"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
        .join(summary, "key", "left")
        .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
                F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
    )


def clean(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no window of an item occurs."""
    hits = stored(occurrences(docs.select("text"), items, window).select("doc").distinct(), "window-docs")
    return packed(docs).withColumn("hit_key", text_key(F.col("row.text"))).join(
        hits, F.col("hit_key") == F.col("doc"), "left_anti").select("row.*")


ORACLE = """
with d as (
    select row_number() over () as rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
    from documents
), b as (
    select item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
    from benchmark
), wins as (
    select distinct item_id, size, list_slice(w, i, i + size - 1) as win from (
        select item_id, w, least(len(w), 10) as size, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as i from b where len(w) > 0
    )
), sizes as (select distinct size from wins), places as (
    select rid, size, i, list_slice(w, i, i + size - 1) as win
    from (select rid, w, size, unnest(range(1, len(w) - size + 2)) as i from d, sizes where len(w) >= size)
), hits as (
    select p.rid, w.item_id, p.i, p.size from places p join wins w on p.win = w.win and p.size = w.size
), covered as (
    select rid, count(distinct pos) as n_hit from (select rid, unnest(range(i, i + size)) as pos from hits) group by rid
), found as (
    select rid, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
    from (select distinct rid, cast(item_id as varchar) as item from hits) group by rid
)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, coalesce(items_sha256, sha256('')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (rid) left join found using (rid)
"""
