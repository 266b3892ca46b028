"""Approximate nearest neighbours by largest inner product, with collision-counting hashing.

Inner products become distances by one more component (``sqrt(M^2 - |x|^2)``, zero for queries, queries at
unit length). Each hash is one random projection, each index one sorted array of projections. A
query counts, over all arrays, how often a vector's projection falls into a window around the query's own.
Windows start narrow and widen by a constant factor (virtual rehashing); a vector that collides
``threshold`` times is verified with its exact inner product (Huang et al. 2015). A query stops once its
windows are made for distances as large as that of its present k-th, or when everything is verified.

Vectors and queries are dealt into blocks of bounded size; each pair of blocks is searched in one task and
the best k of each are merged. So no task holds all vectors or all queries.

Defined results: vectors that are NULL, zero, of another length than most, or hold a NULL or non-finite
component take no part. Ties go to the smaller id. Of rows with the same id each takes part; a query never
finds rows with its own id. Rows without an id take no part. An empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tontine.llm.common import ship

PROJECTIONS = 24
WIDEN = 1.5
VECTORS = 8192
QUERIES = 1024


def usable(vector: Column) -> Column:
    """Neither NULL nor zero, all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def search_block(
    vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, longest: float,
    projections: int, confidence: float, seed: int = 7,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of one block for each query: (query number, vector number, inner product)."""
    n, dim = vectors.shape
    rng = np.random.default_rng(seed)
    directions = rng.standard_normal((dim + 1, projections))
    scale = longest or 1.0
    extra = np.sqrt(np.maximum(scale**2 - (vectors**2).sum(1), 0.0))
    indexed = np.hstack([vectors, extra[:, None]]) / scale
    length = np.sqrt((queries**2).sum(1))
    asked = np.hstack([queries / length[:, None], np.zeros((len(queries), 1))])
    hashed = (indexed @ directions).T
    order = np.argsort(hashed, axis=1, kind="stable").astype(np.int32)
    arrays = np.take_along_axis(hashed, order, 1)
    at = (asked @ directions).T
    # A neighbour at distance r shows a projection within z * r of the query's with probability p; it
    # is verified when it collides in about that share of the arrays.
    z, p = 1.2, 0.7699
    threshold = max(1, int(np.floor(projections * p - confidence * np.sqrt(projections * p * (1 - p)))))
    # The windows of all radii: a factor wider each time, up to the largest distance there is.
    radii = 0.25 * WIDEN ** np.arange(2 + int(np.ceil(np.log(2 / 0.25) / np.log(WIDEN))))
    reach = z * radii[:, None]
    lows = np.stack([np.searchsorted(a, x - reach) for a, x in zip(arrays, at, strict=True)])
    highs = np.stack([np.searchsorted(a, x + reach) for a, x in zip(arrays, at, strict=True)])
    found = []
    for q in range(len(queries)):
        counts, dots = np.zeros(n, np.int64), np.full(n, -np.inf)
        verified = ids == query_ids[q]
        left = right = None
        for step, radius in enumerate(radii):
            low, high = lows[:, step, q], highs[:, step, q]
            if left is None:
                windows = [o[x:y] for o, x, y in zip(order, low, high, strict=True)]
            else:
                windows = [o[x:y] for o, x, y in zip(order, low, left, strict=True)]
                windows += [o[x:y] for o, x, y in zip(order, right, high, strict=True)]
            left, right = low, high
            counts += np.bincount(np.concatenate(windows), minlength=n)
            new = np.flatnonzero((counts >= threshold) & ~verified)
            if len(new):
                verified[new] = True
                dots[new] = vectors[new] @ queries[q]
            if verified.all():
                break
            if np.isfinite(dots).sum() >= k:
                kth = np.partition(dots, n - k)[n - k]
                if np.sqrt(max(0.0, 2.0 - 2.0 * kth / (length[q] * scale))) <= radius:
                    break
        else:
            # Wider than all distances: what is left is verified too.
            new = np.flatnonzero(~verified)
            dots[new] = vectors[new] @ queries[q]
        near = np.flatnonzero(np.isfinite(dots))
        if len(near) > k:
            near = near[dots[near] >= np.partition(dots[near], len(near) - k)[len(near) - k] - 1e-9 * scale * length[q]]
        exact = (vectors[near] * queries[q]).sum(1)
        keep = np.lexsort((ids[near], -exact))[:k]
        found.append((np.full(len(keep), q), near[keep], exact[keep]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def nearest(
    table: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    projections: int = PROJECTIONS,
    confidence: float = 1.0,
    vectors_in_block: int = VECTORS,
    queries_in_block: int = QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each row for which ``is_query`` holds."""
    ship(table.sparkSession)
    kind = "float" if table.schema[vector_col].dataType.elementType.typeName() == "float" else "double"
    v = F.col(vector_col).cast(f"array<{kind}>")
    rows = table.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), is_query.alias("asks"))
    rows = rows.filter(usable(F.col("v")) & F.col("id").isNotNull())
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    rows = rows.filter(F.size("v") == (sizes["d"] if sizes else 0))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, asking, most = rows.agg(
        F.count("*"), F.count(F.when(F.col("asks"), 1)), F.coalesce(F.max(square), F.lit(0.0))
    ).first()
    vector_blocks = max(1, -(-n // vectors_in_block))
    query_blocks = max(1, -(-asking // queries_in_block))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    own = lambda count: F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")
    dealt = rows.select("id", "v", F.lit(False).alias("asks"), own(vector_blocks).alias("vb"), every(query_blocks).alias("qb"))
    asked = rows.filter("asks").select("id", "v", F.lit(True).alias("asks"), every(vector_blocks).alias("vb"), own(query_blocks).alias("qb"))
    longest = float(np.sqrt(most))

    def search(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id", kind="stable")
        mine, questions = part[~part["asks"]], part[part["asks"]]
        if not len(mine) or not len(questions):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        ids, query_ids = mine["id"].to_numpy(np.int64), questions["id"].to_numpy(np.int64)
        q, i, s = search_block(
            np.stack(mine["v"]).astype(float), ids, np.stack(questions["v"]).astype(float), query_ids, k, longest, projections, confidence
        )
        return pd.DataFrame({"query_id": query_ids[q], "vec_id": ids[i], "score": s})

    best = dealt.unionByName(asked).groupBy("vb", "qb").applyInPandas(search, "query_id long, vec_id long, score double")
    from pyspark.sql import Window

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
