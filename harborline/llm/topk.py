"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Candidates and queries are dealt into blocks of bounded size and every query block meets every candidate block once. A
block of candidates holds, for every dimension, its rows sorted by that component. A query reads the lists from the end
that its own component favours, in growing depth; rows met are scored in full, and the query stops as soon as no unread
row can reach its kth score. The best of all blocks are ranked in Spark.

Defined results: vectors that are null or hold null or non-finite components take no part; identical repeated rows count
once; rows that share the query's vec_id are its own and no candidates; a null vec_id is no query and, as a candidate,
comes after all others in ties; shorter vectors count as padded with zeros; scores beyond a long are cut to its range.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm.common import stored

CANDIDATE_BLOCK = 16_384
QUERY_BLOCK = 2_048
_EXACT = 2**53
_LONG = 2**63 - 1
_NO_ID = _LONG
RESULT = "query_id long, vec_id long, score long"


def whole_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, v``: components turned into floor(scale * x), unusable vectors left out."""
    x = F.col("embedding")
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("double"))
    return vectors.filter(usable).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")).distinct()


def _matrix(rows: pd.Series, d: int) -> np.ndarray:
    out = np.zeros((len(rows), d))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _long(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        return np.array([max(-_LONG - 1, min(_LONG, int(s))) for s in scores], dtype=np.int64)
    return scores.astype(np.int64)


def best_in_block(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """Yields ``(query, positions, scores)`` with the k best rows for every query; rows are sorted by id."""
    n, d = rows.shape
    big = max(np.abs(rows).max(initial=0), 1) * max(np.abs(queries).max(initial=0), 1) * max(d, 1) >= _EXACT
    if big:  # products do not fit a double: whole numbers of any size
        rows, queries = (np.vectorize(int, otypes=[object])(m) if m.size else m.astype(object) for m in (rows, queries))
    lists = np.argsort(rows.astype(float), axis=0, kind="stable").T.astype(np.int32) if n else np.zeros((d, 0), np.int32)
    depths = [t for t in (16, 64, 256, 1024, 4096) if t < n] + [n]
    plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
    columns = np.arange(d)
    # what an unread row can reach at most, once so many entries of every list were read
    bound = np.stack([
        plus @ rows[lists[:, n - t], columns] + minus @ rows[lists[:, t - 1], columns] for t in depths
    ], axis=1) if n else np.zeros((len(queries), 0))
    for q in range(len(queries)):
        up, down = np.flatnonzero(queries[q] > 0), np.flatnonzero(queries[q] < 0)
        seen = np.zeros(n, bool)
        got, score, read = np.zeros(0, np.int64), np.zeros(0, rows.dtype), 0
        for level, t in enumerate(depths if n else ()):
            new = np.zeros(n, bool)
            if t == n:
                new[:] = True
            else:
                new[lists[up, n - t: n - read].ravel()] = True
                new[lists[down, read:t].ravel()] = True
            new &= ~seen
            seen |= new
            read = t
            more = np.flatnonzero(new)
            more = more[ids[more] != query_ids[q]]
            got, score = np.concatenate([got, more]), np.concatenate([score, rows[more] @ queries[q]])
            keep = np.lexsort((ids[got], -score))[:k]
            got, score = got[keep], score[keep]
            if len(got) == k and score[-1] > bound[q, level]:
                break
        yield q, got, _long(score)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256,
          candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of every query, ties to the smaller vec_id."""
    data = stored(whole_vectors(vectors, scale), "topk-vectors")
    queries = data.filter(is_query)
    blocks = max(1, -(-data.count() // candidate_block))
    groups = max(1, -(-queries.count() // query_block))
    part = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = data.withColumn("block", part(blocks)).withColumn("group", every(groups))
    right = queries.withColumn("group", part(groups)).withColumn("block", every(blocks))

    def score(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(asked):
            d = max(rows["v"].map(len).max(), asked["v"].map(len).max())
            ids = rows["vec_id"].astype("Int64").fillna(_NO_ID).to_numpy(np.int64)
            order = np.argsort(ids, kind="stable")
            rows, ids = rows.iloc[order], ids[order]
            names = asked["vec_id"].to_numpy(np.int64)
            for q, got, scores in best_in_block(_matrix(asked["v"], d), names, _matrix(rows["v"], d), ids, k):
                found.append(pd.DataFrame({"query_id": names[q], "vec_id": ids[got], "score": scores}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)

    pairs = left.groupBy("block", "group").cogroup(right.groupBy("block", "group")).applyInPandas(score, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.nullif("vec_id", F.lit(_NO_ID)).alias("vec_id"), "score"
    )
