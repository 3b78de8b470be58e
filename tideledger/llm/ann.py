"""Approximate nearest neighbours by cross-polytope hashing.

Each table applies a pseudo-random rotation (three rounds of sign flips and a fast
Hadamard transform) to a unit vector and takes the nearest signed axis as its key.
Every vector lies once in each table. Queries probe the axes that are nearest to
them, and every candidate is scored exactly, in double precision on the
original vectors.

Buckets are searched in blocks: a bucket of any size becomes blocks of at most about
``BLOCK`` vectors and ``QUERIES`` queries, so no task gathers a hot bucket, and no candidate
pair is a row: a block returns the nearest few of each of its queries. Of equal
vectors only the k + 1 smallest ids can be among k nearest, so only those are kept,
which is exact. Queries that find fewer than k probe all axes of one table, that is all
vectors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from . import shipped
from .common import stored

shipped(__name__)

TABLES, PROBES = 8, 9
BLOCK, QUERIES = 4096, 1024
FOUND = "query_id long, vec_id long, score double"


def signs(dim: int, tables: int) -> np.ndarray:
    """Fixed sign flips: tables x 3 rounds x dim."""
    return np.random.default_rng(20240229 + dim).choice(np.array([-1.0, 1.0]), (tables, 3, dim))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotated(vectors: np.ndarray, flips: np.ndarray) -> np.ndarray:
    for sign in flips:
        vectors = hadamard(vectors * sign)
    return vectors


def unit(stacked: np.ndarray) -> np.ndarray:
    """Unit vectors, padded to a power of two; scaled first so that no square overflows or vanishes."""
    stacked = stacked / np.abs(stacked).max(axis=1, keepdims=True)
    stacked = stacked / np.sqrt((stacked * stacked).sum(axis=1, keepdims=True))
    d = 1 << max(stacked.shape[1] - 1, 0).bit_length()
    return np.pad(stacked, ((0, 0), (0, d - stacked.shape[1])))


def axes(vectors: np.ndarray, flips: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` nearest signed axes of each vector: axis j is 2j, its opposite 2j + 1."""
    turned = rotated(vectors, flips)
    both = np.stack((turned, -turned), axis=2).reshape(len(turned), -1)
    count = min(count, both.shape[1])
    if count == 1:
        return both.argmax(axis=1)[:, None]
    return np.argpartition(-both, count - 1, axis=1)[:, :count]


def _keys(vectors: DataFrame, tables: int, probes: int) -> DataFrame:
    """vectors (vec_id, embedding) with dim, table and axis, one row per table and probed axis."""
    def run(batches):
        for batch in batches:
            dims = batch["embedding"].map(len).to_numpy()
            for dim in np.unique(dims):
                part = batch[dims == dim].reset_index(drop=True)
                turned = unit(np.stack(part["embedding"].to_numpy()).astype(float))
                for table, flips in enumerate(signs(turned.shape[1], tables)):
                    near = axes(turned, flips, probes)
                    at = np.repeat(np.arange(len(part)), near.shape[1])
                    yield pd.DataFrame({
                        "vec_id": part["vec_id"].to_numpy()[at], "embedding": part["embedding"].to_numpy()[at],
                        "dim": np.int32(dim), "tab": np.int32(table), "axis": near.ravel().astype(np.int32)})

    return vectors.mapInPandas(run, "vec_id long, embedding array<double>, dim int, tab int, axis int")


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosine in double precision; the same two vectors give the same bits wherever they stand."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _nearest(queries: pd.DataFrame, index: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest in one block, with all ties resolved by id."""
    if queries.empty or index.empty:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
    q, x = np.stack(queries["embedding"].to_numpy()), np.stack(index["embedding"].to_numpy())
    qid, xid = queries["vec_id"].to_numpy(), index["vec_id"].to_numpy()
    rough = unit(q) @ unit(x).T
    rough[qid[:, None] == xid[None, :]] = -np.inf
    take = min(k, rough.shape[1])
    level = np.partition(rough, rough.shape[1] - take, axis=1)[:, rough.shape[1] - take]
    at, to = np.nonzero((rough >= level[:, None] - 1e-9) & np.isfinite(rough))
    out = pd.DataFrame({"query_id": qid[at], "vec_id": xid[to], "score": cosines(q[at], x[to])})
    out = out.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
    return out[out.groupby("query_id").cumcount() < k]


def _search(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """Nearest of each probed bucket, block by block; queries and index: vec_id, embedding, dim, tab, axis."""
    bucket = ["dim", "tab", "axis"]
    blocks = index.groupBy(*bucket).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).join(
        queries.groupBy(*bucket).agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("parts")), bucket)
    here = index.join(blocks, bucket).withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    there = queries.join(blocks, bucket).withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts").cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = [*bucket, "block", "part"]
    columns = [*cell, "vec_id", "embedding"]

    def run(_key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _nearest(left, right, k)

    return there.select(columns).groupBy(*cell).cogroup(here.select(columns).groupBy(*cell)).applyInPandas(run, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    # A pair met in several tables is one row; its score is the same in all.
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.expr("row_number() over (partition by query_id order by score desc, vec_id)").cast("int")).where(
        F.col("rank") <= k)


def usable(vectors: DataFrame, k: int) -> DataFrame:
    """Rows that take part: an id and a vector without null or non-finite components that is not zero.

    Repeated rows count once; of equal vectors the k + 1 smallest ids stay.
    """
    value = F.col("embedding").cast("array<double>")
    fit = (F.col("vec_id").isNotNull() & (F.size(value) > 0)
           & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0))
    return (
        vectors.select("vec_id", value.alias("embedding")).where(fit)
        .withColumn("at", F.expr("dense_rank() over (partition by embedding order by vec_id)")).where(F.col("at") <= k + 1)
        .select("vec_id", "embedding").distinct()
    )


def neighbours(vectors: DataFrame, k: int = 5, every: int = 50, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found for each row whose id is divisible by ``every``.

    Candidates are all rows but those with the query's own id, of the query's
    dimension. Unusable vectors (see :func:`usable`) take no part; an
    empty table gives no rows; other columns are ignored.
    """
    value = F.col("embedding").cast("array<double>")
    index = stored(_keys(usable(vectors, k), tables, 1), "ann-index")
    asked = usable_queries(vectors, every, value)
    found = stored(_ranked(_search(_keys(asked, tables, probes), index, k), k), "ann-found")
    # Queries that found too few see all vectors: every axis of the first table.
    done = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    short = stored(asked.join(done, asked["vec_id"] == done["query_id"], "left_anti"), "ann-short")
    if short.isEmpty():
        return found.select("query_id", "rank", "vec_id", "score")
    rest = _ranked(_search(_keys(short, 1, 1 << 30), index.where("tab = 0"), k), k)
    kept = found.join(short, found["query_id"] == short["vec_id"], "left_anti")
    return kept.select("query_id", "rank", "vec_id", "score").unionByName(rest.select("query_id", "rank", "vec_id", "score"))


def usable_queries(vectors: DataFrame, every: int, value) -> DataFrame:
    """The stated queries among the usable rows."""
    fit = ((F.col("vec_id") % every == 0) & (F.size(value) > 0)
           & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0))
    return vectors.select("vec_id", value.alias("embedding")).where(fit).dropDuplicates(["vec_id"])
