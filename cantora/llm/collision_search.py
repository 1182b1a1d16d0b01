"""Approximate nearest neighbours by collision-counting hashing.

Each block of vectors (scaled to unit length) is projected on M random directions, and each projection
is kept as one sorted array. A query's windows, centred on its own projections, are widened round by
round (virtual rehashing: no table is rebuilt); a vector that falls into at least THRESHOLD * M windows
is verified with its exact cosine. The rounds end once K verified vectors lie within the round's
radius, or all vectors are verified. A window holds a vector at the radius with probability P(|z| <= HALF) of a normal z, above the threshold, and one that is
farther with less; many directions and small steps of the radius keep the two apart, so that few vectors are verified.

All queries meet all blocks: candidates are dealt into blocks of at most BLOCK by a hash of the row, queries into
blocks of at most QUERIES, and a group is a pair of blocks. The best of all groups are merged by rank. The work is queries times vectors; rows are copied once for each block of the other side.
The index of a block is made where it is used and never leaves the executor.

A row is an id and a vector: rows that repeat both count once, different vectors under one id are rows of their own, each a candidate and, where its id is divisible, a query. Rows without an id
and vectors that are null, empty, zero or hold null or non-finite components take no part. Only vectors of one length are compared. Ties go to the smaller id. An empty table gives no rows. Only
vec_id and embedding are read, whatever other columns are called.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cantora.llm.common import table

K, M = 5, 160
BLOCK, QUERIES = 16_384, 32_768
#: Half-width of a window over the radius, and the share of windows that verifies.
HALF, THRESHOLD = 1.0, 0.64
LEAST_RADIUS, GROWTH = 0.1, 1.05
#: Vectors that the first radius is judged by, and the share of that estimate to begin with; queries whose windows are found together.
SAMPLE, SHARE, AT_ONCE = 256, 0.85, 256


def directions(dim: int, m: int = M, seed: int = 17) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, m))


def scaled(rows: list) -> np.ndarray:
    """Rows as doubles of largest component 1, so that no square over- or underflows."""
    x = np.array(rows, float)
    return x / np.abs(x).max(1, keepdims=True)


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Equal rows get equal values: each row is summed in the same order."""
    return np.einsum("ij,j->i", x, q) / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("j,j->", q, q)))


def first_radius(unit: np.ndarray, k: int) -> float:
    """Where widening begins: somewhat below the distance within which k vectors are expected, judged by the cosines of SAMPLE vectors as if they were normal. It saves rounds and
    changes no rule: nearer vectors lie in the first windows."""
    some = unit[:SAMPLE].astype(float)
    cosine = (some @ some.T)[np.triu_indices(len(some), 1)]
    if not len(cosine):
        return LEAST_RADIUS
    level = cosine.mean() + NormalDist().inv_cdf(max(0.5, 1 - k / len(unit))) * cosine.std()
    return float(np.clip(np.sqrt(max(0.0, 2 - 2 * level)) * SHARE, LEAST_RADIUS, 2.0))


def search_block(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, own: np.ndarray, k: int = K, m: int = M) -> tuple[list[tuple[int, int, float]], int]:
    """(query's number, vector id, cosine) of the k best that the collision counts bring up, for each query; and how many vectors were verified. own: for each query the position of its own
    row in ``vectors``, or -1."""
    n = len(vectors)
    unit = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    a = directions(vectors.shape[1], m).astype(np.float32)
    projected = unit @ a
    order = np.argsort(projected, axis=0, kind="stable").astype(np.int32)
    keys = np.ascontiguousarray(np.take_along_axis(projected, order, 0).T)
    order = np.ascontiguousarray(order.T)
    need = int(np.ceil(THRESHOLD * m))
    radii = [first_radius(unit, k)]
    while radii[-1] < 2 * GROWTH:
        radii.append(radii[-1] * GROWTH)
    widths = HALF * np.array(radii, np.float32)
    unit_queries = (queries / np.linalg.norm(queries, axis=1, keepdims=True)).astype(np.float32)
    out, checked = [], 0
    for x, q in enumerate(queries):
        if x % AT_ONCE == 0:
            at = (unit_queries[x : x + AT_ONCE] @ a)[:, :, None]
            # bounds of the windows of some queries at all radii, for each direction
            lows = np.stack([np.searchsorted(keys[j], at[:, j] - widths) for j in range(m)], 1)
            highs = np.stack([np.searchsorted(keys[j], at[:, j] + widths, "right") for j in range(m)], 1)
        low, high = lows[x % AT_ONCE], highs[x % AT_ONCE]
        counts = np.zeros(n, np.int64)
        verified = np.zeros(n, bool)
        if own[x] >= 0:
            verified[own[x]] = True
        cosine = np.full(n, -np.inf, np.float32)
        inside = np.stack([low[:, 0], low[:, 0]])
        for r, radius in enumerate(radii):
            new = [order[j, s:e] for j in range(m) for s, e in ((low[j, r], inside[0, j]), (inside[1, j], high[j, r])) if e > s]
            inside = np.stack([low[:, r], high[:, r]])
            if new:
                counts += np.bincount(np.concatenate(new), minlength=n)
            due = np.flatnonzero(~verified if r == len(radii) - 1 else (counts >= need) & ~verified)
            if len(due):
                verified[due] = True
                checked += len(due)
                cosine[due] = unit[due] @ unit_queries[x]
            # |u - v|^2 = 2 - 2 cos
            if (cosine >= 1 - radius * radius / 2).sum() >= k:
                break
        found = np.flatnonzero(cosine > -np.inf)
        if len(found) > k:  # the exact measure, for all that rounding could put among the k best
            found = found[cosine[found] >= np.partition(cosine[found], -k)[-k] - 1e-5]
        exact = cosines(vectors[found], q)
        best = np.lexsort((ids[found], -exact))[:k]
        out += [(x, int(ids[found[i]]), float(exact[i])) for i in best]
    return out, checked


def usable(column: str = "embedding"):
    """Vectors that take part: not null, not empty, all components finite, not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    c = F.col(column)
    return c.isNotNull() & (F.size(c) > 0) & F.coalesce(F.forall(c, finite), F.lit(False)) & F.coalesce(F.exists(c, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, is_query, k: int = K, block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score, verified) for rows of ``vectors`` (vec_id, embedding) that ``is_query`` holds for, against all. Fewer than ``k`` candidates: all of them.
    verified: how many vectors the queries of this one's block of vectors and queries had verified, on average."""
    n = max(1, vectors.count())
    blocks, query_blocks = -(-n // block), -(-max(1, vectors.where(is_query).count()) // query_block)
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & usable())
    rows = rows.withColumn("row", F.xxhash64("embedding")).groupBy("vec_id", "row").agg(F.first("embedding").alias("embedding")).withColumn("dim", F.size("embedding"))
    lot = F.xxhash64("vec_id", "row")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    candidates = rows.withColumn("b", F.pmod(lot, F.lit(blocks)).cast("int")).withColumn("q", every(query_blocks))
    queries = rows.where(is_query).withColumn("q", F.pmod(F.shiftrightunsigned(lot, 20), F.lit(query_blocks)).cast("int")).withColumn("b", every(blocks))
    columns = ["query_id", "row", "vec_id", "score", "verified"]

    def search(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(c) or not len(q):
            return pd.DataFrame([], columns=columns)
        c, q = c.sort_values(["vec_id", "row"]), q.sort_values(["vec_id", "row"])
        ids, query_ids, marks = c["vec_id"].to_numpy(), q["vec_id"].to_numpy(), q["row"].to_numpy()
        place = {x: i for i, x in enumerate(zip(ids.tolist(), c["row"].tolist(), strict=True))}
        own = np.array([place.get(x, -1) for x in zip(query_ids.tolist(), marks.tolist(), strict=True)])
        found, checked = search_block(scaled(c["embedding"].tolist()), ids, scaled(q["embedding"].tolist()), query_ids, own, k)
        return pd.DataFrame([(query_ids[x], marks[x], v, score, checked / len(q)) for x, v, score in found], columns=columns)

    groups = ["dim", "b", "q"]
    found = candidates.groupBy(*groups).cogroup(queries.groupBy(*groups)).applyInPandas(search, "query_id long, row long, vec_id long, score double, verified double")
    # k rows from each block at most
    ranked = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "verified")


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every row of ``embeddings`` whose vec_id is divisible by 50."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
