"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Vectors are dealt into shards by a hash of their id. Within a shard each dimension
has a list of the shard's vectors sorted by that component. For a query the lists are
read from the end that its component favours; every vector met is scored in full, and
reading stops once the threshold - the score of a vector that stood at the current
depth of all lists at once - is below the k-th best score. Shards work apart on blocks of
queries; the best k of each are merged by rank."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARD_ROWS = 16384
QUERY_BLOCK = 1024
#: Entries read from each list in the first step; later steps double it.
FIRST_DEPTH = 16


def threshold_search(lists: np.ndarray, vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best ``k`` rows of ``vectors`` for ``query`` by score, then smaller id, without ids equal to ``own``.

    ``lists[d]`` holds the row numbers in ascending order of component d. Returns row numbers, scores and
    how deep the lists were read."""
    n, dims = vectors.shape
    use = np.flatnonzero(query)
    seen = ids == own
    best_rows, best_scores = np.zeros(0, np.int64), np.zeros(0, vectors.dtype)
    depth, step = 0, FIRST_DEPTH
    if not len(use):  # every score is 0: the smallest ids win
        rest = np.flatnonzero(~seen)
        rest = rest[np.argsort(ids[rest], kind="stable")[:k]]
        return rest, np.zeros(len(rest), vectors.dtype), 0
    up = query[use] > 0
    while depth < n:
        to = min(n, depth + step)
        part = np.where(up[:, None], lists[use, n - to : n - depth], lists[use, depth:to])
        # positions n-to..n-depth-1 from the high end, depth..to-1 from the low end
        fresh = np.zeros(n, bool)
        fresh[part] = True
        fresh &= ~seen
        rows = np.flatnonzero(fresh)
        seen |= fresh
        if len(rows):
            rows = np.concatenate([best_rows, rows])
            scores = np.concatenate([best_scores, vectors[rows[len(best_rows):]] @ query])
            order = np.lexsort((ids[rows], -scores))[:k]
            best_rows, best_scores = rows[order], scores[order]
        last = np.where(up, lists[use, n - to], lists[use, to - 1])
        depth, step = to, step * 2
        # an equal score could still come with a smaller id: stop only strictly below
        if len(best_rows) == k and (query[use] * vectors[last, use]).sum() < best_scores[-1]:
            break
    return best_rows, best_scores, depth


def _search(k: int):
    def search(key, shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(shard) and len(queries):
            vectors, asked = np.array(shard["v"].tolist(), np.int64), np.array(queries["q"].tolist(), np.int64)
            ids = shard["vec_id"].to_numpy(np.int64)
            largest = int(np.abs(vectors).max(initial=0)) * int(np.abs(asked).max(initial=0)) * vectors.shape[1]
            # doubles add integers exactly up to 2^53; Python integers beyond
            kind = np.float64 if largest < 1 << 53 else object
            vectors, asked = vectors.astype(kind), asked.astype(kind)
            lists = np.argsort(vectors, axis=0, kind="stable").T
            for qid, q in zip(queries["query_id"].tolist(), asked, strict=True):
                rows, scores, depth = threshold_search(lists, vectors, ids, q, qid, k)
                out += [(qid, int(ids[r]), int(s), depth, len(ids)) for r, s in zip(rows, scores, strict=True)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score", "depth", "list_length"])

    return search


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``vectors`` (vec_id long, embedding array; others ignored) and a condition that marks queries ->
    query_id, rank, vec_id, score, depth (list entries read in the shard that gave the row), list_length.

    Components become floor(scale * x); scores are integer inner products, exact at any size that fits 64 bits.
    Each query meets every vector of its length but those with its own id; the ``k`` best come by score,
    ties to the smaller vec_id, fewer if there are fewer. Vectors that are null or hold a null or non-finite
    component, and null ids, take no part. Rows repeated in full count once. Empty tables give no rows."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    v = v.where(F.col("vec_id").isNotNull() & F.col("e").isNotNull()
                & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    v = v.select("vec_id", F.transform("e", lambda x: F.floor(x * scale)).alias("v"), F.size("e").alias("dim"))
    v = v.where("dim > 0").distinct()
    n = v.count()
    shards = max(1, -(-n // shard_rows))
    asked = v.where(is_query)
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    blocks_of = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    shards_of = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    # every shard meets every block of queries: a stated query set against all rows, block by block
    data = v.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).withColumn("block", blocks_of)
    ask = asked.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(query_blocks)).cast("int")).withColumn("shard", shards_of)
    ask = ask.select("shard", "block", "dim", F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    keys = ["shard", "block", "dim"]
    found = data.groupBy(*keys).cogroup(ask.groupBy(*keys)).applyInPandas(
        _search(k), "query_id long, vec_id long, score long, depth long, list_length long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "depth", "list_length"))
