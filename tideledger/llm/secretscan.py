"""Secrets: fixed patterns, and tokens that a battery of randomness tests takes for keys.

A candidate is a run of 20 or more characters of ``[A-Za-z0-9+/=_-]`` with a
letter and a digit. Its encoding is the smallest alphabet that holds it, and the
characters become numbers of that alphabet. Three tests measure it against a
uniform draw: chi-squared over the alphabet, runs above and below the middle, and
lag-one serial correlation. Two questions are then asked:

* could it be ordinary? Chi-squared, scaled by length and alphabet so that it grows with neither
  (the rate of equal characters among its pairs: 1 / alphabet for uniform draws, about 0.07 for
  words, 1 for one repeated letter), is compared with the
  long runs without any digit (ordinary words) of the same length band. Their median and the
  distance to the quantile one deviation below it are taken over the whole corpus, so repeated
  letters, however long, move neither. Bands have the same rule whatever they hold: five
  reference runs are always part of them. The resulting p-values pass a
  Benjamini-Hochberg cut within each length band, so long texts full of runs do
  not buy false alarms;
* does it look random? Bonferroni's p-value of the three tests must not reject
  uniformity.

The cut needs only a histogram of p-values per band (bounded, whatever the
corpus), so ranks never pass through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import spans as S
from .common import LOWER, UPPER, let, stored, text_key

ASSIGN = (r"(?i:password|passwd|secret|token|api_?key)[\"']?+\x20*+[:=]\x20*+[\"']?+([A-Za-z0-9+/_.=-]++)")
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
RUN = r"[A-Za-z0-9+/=_-]{20,}+"
KINDS = ("assign", "access", "hex", "random")
DIGITS = "0123456789"
# Encodings from the smallest alphabet to the largest: name, test, characters in order.
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("hex_upper", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("base36", "^[a-z0-9]+$", DIGITS + LOWER),
    ("base36_upper", "^[A-Z0-9]+$", DIGITS + UPPER),
    ("base62", "^[A-Za-z0-9]+$", DIGITS + UPPER + LOWER),
    ("base64", ".", UPPER + LOWER + DIGITS + "+/-_"),
)
BINS = 400        # of -log10(p), 0.05 wide
FALSE_RATE = 0.01
UNIFORM_P = 1e-4  # uniformity is rejected below this
WORDY = 36.0      # least alphabet that ordinary words can fill; smaller ones count as a share of it
STEPS = 1000      # histogram steps of the ordinary runs' rate, which lies in 0..1
# Runs that every band has besides its own: rates of words in lower case.
REFERENCE = (0.06, 0.07, 0.08, 0.09, 0.1)
LEAST_SPREAD = 0.003


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns; an assignment spans keyword, separator and value."""
    low = F.lower(text)
    keyword = low.contains("pass") | low.contains("secret") | low.contains("token") | low.contains("key")
    assign = F.filter(S.spans(text, ASSIGN, "assign", 0, keyword),
                      lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 1)) >= 6)
    return F.concat(assign, S.spans(text, ACCESS, "access", 1, text.contains("AKIA")),
                    S.spans(text, HEX, "hex", 2, text.rlike("[0-9a-f]{24}")))


def normal_tail(z: Column) -> Column:
    """Upper tail of the normal distribution (Abramowitz-Stegun 26.2.17, error under 1e-7; Mills' ratio far out)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _total(values: Column, term) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + term(x))


def _measures(token: Column) -> Column:
    """encoding, n characters, k letters, and the sums behind the tests; every value is bound once, so long runs cost no more than their length."""
    body = F.regexp_replace(token, "=+$", "")
    named = let(body, lambda b: F.struct(b.alias("body"), F.coalesce(
        *(F.when(b.rlike(test), F.lit(n)) for n, test, _ in ENCODINGS)).alias("encoding")))
    spelled = let(named, lambda s: F.struct(s["body"].alias("body"), s["encoding"].alias("encoding"), F.coalesce(
        *(F.when(s["encoding"] == n, F.lit(chars)) for n, _, chars in ENCODINGS)).alias("alphabet")))
    numbered = let(spelled, lambda s: F.struct(
        s["encoding"].alias("encoding"), F.length(s["alphabet"]).cast("double").alias("k"),
        F.transform(F.filter(F.split(s["body"], ""), lambda c: c != ""),
                    lambda c: (F.call_function("instr", s["alphabet"], c) - 1).cast("double")).alias("x")))
    centred = let(numbered, lambda s: F.struct(
        s["encoding"].alias("encoding"), s["k"].alias("k"), s["x"].alias("x"), F.size(s["x"]).cast("double").alias("n"),
        (_total(s["x"], lambda x: x) / F.size(s["x"])).alias("mean"), ((s["k"] - 1) / 2).alias("middle"),
        F.slice(s["x"], F.lit(2), F.size(s["x"])).alias("next")))
    pairs = lambda s, f: F.zip_with(F.slice(s["x"], F.lit(1), F.size(s["next"])), s["next"], f)
    return let(centred, lambda s: F.struct(
        s["encoding"].alias("encoding"), s["n"].alias("n"), s["k"].alias("k"),
        _total(F.sequence(F.lit(0), s["k"].cast("int") - 1), lambda v: F.pow(
            F.size(F.filter(s["x"], lambda x: x == v)).cast("double"), F.lit(2.0))).alias("squares"),
        _total(s["x"], lambda x: F.when(x > s["middle"], 1.0).otherwise(0.0)).alias("above"),
        _total(pairs(s, lambda x, y: (x > s["middle"]) != (y > s["middle"])), lambda c: F.when(c, 1.0).otherwise(0.0)).alias("changes"),
        _total(s["x"], lambda x: (x - s["mean"]) * (x - s["mean"])).alias("variance"),
        _total(pairs(s, lambda x, y: (x - s["mean"]) * (y - s["mean"])), lambda c: c).alias("lagged")))


def battery(runs: DataFrame) -> DataFrame:
    """``runs`` (token) with encoding, size, rate (chi-squared scaled by length: pairs of equal characters) and p_uniform."""
    measured = stored(runs.where(~F.col("token").rlike("^.?=*$")).withColumn("m", _measures(F.col("token"))), "secret-measures")
    n, k, above = F.col("m.n"), F.col("m.k"), F.col("m.above")
    chi = (k / n * F.col("m.squares") - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    runs_mean = 2 * above * (n - above) / n + 1
    runs_var = (runs_mean - 1) * (runs_mean - 2) / (n - 1)
    z_runs = F.when(runs_var > 0, (F.col("m.changes") + 1 - runs_mean) / F.sqrt(runs_var)).otherwise(F.lit(9.0))
    z_lag = F.when(F.col("m.variance") > 0, (F.col("m.lagged") / F.col("m.variance") + 1 / n) * F.sqrt(n)).otherwise(F.lit(9.0))
    return measured.select(
        "token", F.col("m.encoding").alias("encoding"), n.cast("int").alias("size"),
        ((F.col("m.squares") - n) / (n * (n - 1)) * k / F.greatest(k, F.lit(WORDY))).alias("rate"),
        F.least(F.lit(1.0), 3 * F.least(normal_tail(chi), 2 * normal_tail(F.abs(z_runs)), 2 * normal_tail(F.abs(z_lag)))).alias("p_uniform"))


def _band(size: Column) -> Column:
    """Length bands 20-27, 28-39, 40-55, 56-79, 80 and more."""
    return (F.when(size < 28, 0).when(size < 40, 1).when(size < 56, 2).when(size < 80, 3).otherwise(4))


def random_tokens(runs: DataFrame, rate: float = FALSE_RATE) -> DataFrame:
    """The distinct tokens of ``runs`` (token, n occurrences) that pass the battery and the false-discovery cut."""
    tested = stored(
        battery(runs)
        .withColumn("band", _band(F.col("size")))
        .withColumn("candidate", F.col("token").rlike("[0-9]") & F.col("token").rlike("[A-Za-z]")),
        "secret-battery",
    )
    ordinary = (
        tested.where("not candidate and token rlike '^[A-Za-z]+$'").withColumn("level", F.round(F.col("rate") * STEPS).cast("int")).groupBy("band", "level")
        .agg(F.count("*").alias("n"))  # at most 5 x 1001 rows
    )
    levels = tested.sparkSession.createDataFrame([(band, round(x * STEPS), 1) for band in range(5) for x in REFERENCE], "band int, level int, n long")
    usual = ordinary.unionByName(levels).groupBy("band").agg(
        F.expr("percentile(level, 0.5, n)").alias("middle"), F.expr("percentile(level, 0.1587, n)").alias("low"))
    p = normal_tail((F.col("middle") - F.col("rate") * STEPS) / F.greatest(F.col("middle") - F.col("low"), F.lit(LEAST_SPREAD * STEPS)))
    scored = (
        tested.where("candidate").join(F.broadcast(usual), "band")
        .withColumn("bin", F.least(F.lit(BINS), F.floor(-F.log10(F.greatest(p, F.lit(1e-30))) * 20)).cast("int"))
    )
    per_bin = scored.groupBy("band", "bin").agg(F.count("*").alias("n"))  # at most 5 x 401 rows
    above = per_bin.alias("a").join(per_bin.alias("b"), F.expr("a.band = b.band")).groupBy(
        F.col("a.band").alias("band"), F.col("a.bin").alias("bin")).agg(
        F.sum(F.expr("if(b.bin >= a.bin, b.n, 0)")).alias("rank"), F.sum("b.n").alias("m"))
    cut = above.where(F.pow(F.lit(10.0), -F.col("bin") / 20) <= rate * F.col("rank") / F.col("m")).groupBy("band").agg(
        F.min("bin").alias("cut"))
    return scored.join(cut, "band").where((F.col("bin") >= F.col("cut")) & (F.col("p_uniform") >= UNIFORM_P)).select(
        "token", "encoding", "p_uniform")


def find(docs: DataFrame, rate: float = FALSE_RATE) -> DataFrame:
    """``docs`` (doc_id, text) with arrays ``base`` and ``random`` of spans.

    A null text counts as empty; rows keep their number, repeated or null
    doc_ids included; other columns are ignored. Random tokens that overlap a
    fixed span are not repeated.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    runs = S.spans(text, RUN, "random", 3, text.rlike(RUN))
    places = stored(
        docs.select(text_key(text).alias("key"), base_spans(text).alias("base"), F.explode_outer(runs).alias("t"))
        .where("t is not null")
        .select("key", F.col("t.start").alias("start"), F.col("t.end").alias("end"), F.col("t.hit").alias("token"),
                F.exists("base", lambda s: (s["start"] < F.col("t.end")) & (s["end"] > F.col("t.start"))).alias("known"))
        .groupBy("key", "start", "end").agg(F.first("token").alias("token"), F.first("known").alias("known")),
        "secret-places",
    )
    tokens = random_tokens(places.groupBy("token").agg(F.count("*").alias("n")), rate)
    found = (
        places.where("not known").join(tokens.select("token"), "token", "left_semi").groupBy("key")
        .agg(F.collect_list(F.struct(
            F.col("start"), F.lit(3).alias("ord"), F.col("end"), F.lit("random").alias("kind"),
            F.col("token").alias("hit"), F.lit("").alias("before")).cast(S.SPAN)).alias("random"))
    )
    return (
        docs.select("doc_id", text_key(text).alias("key"), base_spans(text).alias("base"))
        .join(found, "key", "left").select("doc_id", "base", F.coalesce("random", S.none()).alias("random"))
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash and listing of the spans of :func:`find`."""
    return found.select(
        "doc_id", *(S.count(F.col("base"), kind).alias(f"n_{kind}") for kind in KINDS[:3]),
        F.sha2(S.listing(F.col("base")), 256).alias("base_sha256"),
        S.listing(F.concat("base", "random")).alias("spans"), F.size("random").cast("long").alias("n_random"),
    )
