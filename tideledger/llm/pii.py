"""Personal data: fixed patterns, and identifiers found by bootstrapped context patterns.

The fixed patterns give the seeds. A lexical pattern is the two words before a
token that holds a digit or an @ (other such tokens are words too, with 0 for digits, and
so is the start of the text); an instance is the token itself. Patterns and
instances form a graph with one edge per distinct pair. In each round a pattern
scores the mean score of its instances, and is accepted with enough score and enough
instances that are seeds or were found in an earlier round; an instance that is no seed scores
1 - prod(1 - score of its accepted patterns). Patterns accepted in the last round
mark the tokens behind them as ``context`` spans. All counts are over
the whole corpus, and every step is a grouping or an equi-join that combines
before the shuffle; nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import spans as S
from .common import stored, text_key

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Whole tokens that hold a digit or an @.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
KINDS = ("email", "ip", "card", "phone", "context")
CONTEXT = 64  # characters before a token in which its two words are sought; a longer word counts with its end


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns; possessive quantifiers and look-behinds keep the search linear in the text."""
    digit = text.rlike("[0-9]")
    ip = F.filter(S.spans(text, IP, "ip", 1, digit & text.contains(".")), lambda s: F.forall(
        F.split(s["hit"], r"\."), lambda part: F.length(F.ltrim(part, F.lit("0"))).cast("int").between(0, 3)
        & (F.coalesce(F.right(part, F.lit(3)).try_cast("int"), F.lit(0)) <= 255)))
    card = F.filter(S.spans(text, CARD, "card", 2, digit), lambda s: F.length(_digits(s["hit"])).between(12, 19)
                    & F.call_function("luhn_check", _digits(s["hit"])))
    phone = F.filter(S.spans(text, PHONE, "phone", 3, digit & text.contains("+")),
                     lambda s: F.length(_digits(s["hit"])).between(9, 15))
    return F.concat(S.spans(text, EMAIL, "email", 0, text.contains("@")), ip, card, phone)


def _occurrences(docs: DataFrame) -> DataFrame:
    """One row per token of a text that holds a digit or an @: where it is, its pattern, whether it is a seed."""
    text = F.col("text")
    tokens = S.spans(text, TOKEN, "context", 4, text.rlike("[0-9@]"), CONTEXT)
    near = F.lower(F.regexp_replace(F.col("t.before"), "[0-9]+", "0"))
    words = F.filter(F.split(near, r"\s+"), lambda w: w != "")
    return (
        docs.select(text_key(text).alias("key"), base_spans(text).alias("base"), F.explode_outer(tokens).alias("t"))
        .where("t is not null")
        .withColumn("words", F.slice(F.reverse(words), 1, 2))  # never empty: the text's start is a word
        .select(
            "key", F.col("t.start").alias("start"), F.col("t.end").alias("end"), F.col("t.hit").alias("instance"),
            F.array_join("words", " ").alias("pattern"),
            F.exists("base", lambda s: (s["start"] < F.col("t.end")) & (s["end"] > F.col("t.start"))).alias("seed"),
        )
    )


def _rounds(edges: DataFrame, rounds: int, min_seeds: int, min_score: float) -> DataFrame:
    """The patterns accepted in the last of ``rounds`` passes over the pattern-instance graph; edges: pattern, instance, seed (0 or 1).

    Support are the seeds and the instances that accepted patterns of the round before gave a score of ``min_score``.
    Only accepted patterns are heard: a number that stands behind very many weak ones earns nothing.
    """
    def accepted(known: DataFrame) -> DataFrame:
        return known.groupBy("pattern").agg(
            F.avg("score").alias("pattern_score"), F.sum((F.col("score") >= min_score).cast("int")).alias("support")
        ).where((F.col("support") >= min_seeds) & (F.col("pattern_score") >= min_score))

    known = edges.withColumn("score", F.col("seed").cast("double"))
    for _ in range(rounds - 1):
        heard = (
            edges.where("seed = 0").join(accepted(known), "pattern").groupBy("instance")
            .agg((1 - F.exp(F.sum(F.log1p(-F.least("pattern_score", F.lit(1 - 1e-9)))))).alias("heard"))
        )
        known = stored(
            edges.join(heard, "instance", "left")
            .withColumn("score", F.when(F.col("seed") == 1, 1.0).otherwise(F.coalesce("heard", F.lit(0.0)))).drop("heard"),
            "pii-edges",
        )
    return accepted(known)


def find(docs: DataFrame, rounds: int = 3, min_seeds: int = 3, min_score: float = 0.6) -> DataFrame:
    """``docs`` (doc_id, text) with arrays ``base`` and ``context`` of spans.

    A null text counts as empty; rows keep their number, repeated or null
    doc_ids included; columns other than doc_id and text are ignored. A pattern
    counts with a score of ``min_score`` and ``min_seeds`` different instances that
    are seeds or that other patterns found in an earlier round. A context span never overlaps a fixed one.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # One row per text, token and place: copies of a text fall together before the shuffle.
    places = stored(
        _occurrences(docs).groupBy("key", "start", "end")
        .agg(F.first("instance").alias("instance"), F.first("pattern").alias("pattern"), F.first("seed").alias("seed")),
        "pii-places",
    )
    edges = stored(
        places.groupBy("pattern", "instance")
        .agg(F.max(F.col("seed").cast("int")).alias("seed")),
        "pii-graph",
    )
    good = _rounds(edges, rounds, min_seeds, min_score)
    found = (
        places.where("not seed").join(good.select("pattern"), "pattern", "left_semi").groupBy("key")
        .agg(F.collect_list(F.struct(
            F.col("start"), F.lit(4).alias("ord"), F.col("end"), F.lit("context").alias("kind"),
            F.col("instance").alias("hit"), F.lit("").alias("before")).cast(S.SPAN)).alias("context"))
    )
    return (
        docs.select("doc_id", text_key(F.col("text")).alias("key"), base_spans(F.col("text")).alias("base"))
        .join(found, "key", "left").select("doc_id", "base", F.coalesce("context", S.none()).alias("context"))
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash and listing of the spans of :func:`find`."""
    return found.select(
        "doc_id", *(S.count(F.col("base"), kind).alias(f"n_{kind}") for kind in KINDS[:4]),
        F.sha2(S.listing(F.col("base")), 256).alias("base_sha256"),
        S.listing(F.concat("base", "context")).alias("spans"), F.size("context").cast("long").alias("n_context"),
    )
