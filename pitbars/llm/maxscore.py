"""Exact top-k inner products by MaxScore, shard by shard.

Each component is a query term; its postings in a shard are the shard's values of that component.
Rows are taken in blocks. From a block's least and greatest value of each component follows a bound
of what a term can add to a score. Terms are split by these bounds: the essential ones are those
without which no row can reach the k-th best score so far. Essential postings are traversed for all
rows of the block; the non-essential terms are probed one by one, the strongest first, only for rows
that can still compete with all bounds that are left. What remains has its exact score.

Queries are dealt out in groups of about ``QUERIES`` and rows in shards of about ``ROWS``; each pair
of group and shard is worked off on its own and the shards' best rows are merged per query. No row
is left out and no partner capped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitbars.llm.common import picked

SCALE = 1024
#: Rows of a shard, queries of a group, rows of a block with bounds of its own.
ROWS, QUERIES, BLOCK = 32_768, 2_048, 2_048


def top(query: np.ndarray, own: int, ids: np.ndarray, postings: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best rows, ties to smaller ids; `postings` is term by row, ids ascend."""
    best_ids, best = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    for a in range(0, len(ids), BLOCK):
        rows = np.arange(a, min(len(ids), a + BLOCK))
        rows = rows[ids[rows] != own]
        if not len(rows):
            continue
        part = postings[:, rows]
        bound = np.maximum(query * part.min(axis=1), query * part.max(axis=1))
        order = np.argsort(-bound, kind="stable")
        rest = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0]])  # of the terms from here on
        least = best[k - 1] if len(best) >= k else None
        # Essential: all terms up to where the others' bounds alone can't reach the k-th best.
        essential = len(order) if least is None else int(np.argmax(rest < least)) if (rest < least).any() else len(order)
        scores = query[order[:essential]] @ part[order[:essential]]
        at = np.arange(len(rows))
        for x in range(essential, len(order)):
            alive = scores + rest[x] >= least
            at, scores = at[alive], scores[alive]
            if not len(at):
                break
            scores = scores + query[order[x]] * part[order[x], at]
        if least is not None:
            alive = scores >= least
            at, scores = at[alive], scores[alive]
        best_ids, best = np.concatenate([best_ids, ids[rows[at]]]), np.concatenate([best, scores])
        if len(best) >= k:
            keep = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[keep], best[keep]
    order = np.lexsort((best_ids, -best))
    return best_ids[order], best[order]


def _cell(k: int):
    """Best rows of one shard for one group of queries. Vectors of another length than a query's are
    no candidates of it."""

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rows = rows.sort_values("id", kind="stable")
        sizes = rows["v"].map(len).to_numpy()
        for size in np.unique(queries["v"].map(len)):
            there = rows[sizes == size]
            if len(there) and size:
                ids, postings = there["id"].to_numpy(np.int64), np.ascontiguousarray(np.stack(there["v"].to_numpy()).astype(np.int64).T)
                for q, v in zip(queries["id"], queries["v"]):
                    if len(v) == size:
                        found, scores = top(np.asarray(v, dtype=np.int64), int(q), ids, postings, k)
                        out.append((np.full(len(found), q), found, scores))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, dtype=np.int64)] * 3
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))

    return run


def search(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the greatest inner product for each row whose
    vec_id is divisible by `every`.

    Components become floor(scale * x). Rows without id, or whose vector is null or empty or holds a
    null or something that is not finite, take no part. Rows with the same id and vector count once;
    of a query id with several vectors the least one asks, and all are candidates of other queries.
    Scores must fit in 64 bits. Ties go to the smaller vec_id. No row, no result.
    """
    rows = picked(vectors, id="vec_id", v="embedding").select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v"))
    whole = F.col("id").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(whole).select("id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("v")).distinct()
    asked = rows.where(F.pmod("id", F.lit(every)) == 0).groupBy("id").agg(F.min("v").alias("v"))
    n, q = rows.agg(F.count("*"), F.count_if(F.pmod("id", F.lit(every)) == 0)).first()
    shards, groups = max(1, -(-n // ROWS)), max(1, -(-q // QUERIES))
    shard = F.pmod(F.xxhash64("id", "v"), F.lit(shards))
    group = F.pmod(F.xxhash64("id"), F.lit(groups))
    left = asked.select("id", "v", group.alias("group"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
    right = rows.select("id", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"), shard.alias("shard"))
    found = left.groupBy("group", "shard").cogroup(right.groupBy("group", "shard")).applyInPandas(_cell(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


SQL = f"""
WITH v AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), q AS (SELECT vec_id, min(v) AS v FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id),
s AS (
    SELECT q.vec_id AS query_id, v.vec_id,
           CAST(list_sum(list_transform(range(1, len(v.v) + 1), lambda i: v.v[i] * q.v[i])) AS BIGINT) AS score
    FROM q JOIN v ON v.vec_id <> q.vec_id AND len(v.v) = len(q.v)
), r AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
