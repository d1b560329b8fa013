"""Exact top-k search by Fagin's threshold algorithm.

Candidates are dealt by hash into blocks of bounded size, queries likewise, and every
pair of blocks is one group. In a group each dimension has a list of the candidates
sorted by that component. A query walks the lists of its non-zero components from the
end that raises its score, a stretch at a time; every candidate it meets is scored at
once. What it has not met can score no more than the sum of the components it stands
at, and it stops when that bound is below its kth score. At equality it goes on, as a
candidate with an equal score and a smaller id would come first. The best of each
block are merged per query by rank, after a group limit in each task.

Components are floor(scale * x) with x as double. Vectors that are null or hold a null
or non-finite component, and rows without vec_id, take no part; so does a pair of
different lengths. Rows that repeat id and vector count once. Where an id has several
vectors, each is a candidate and the smallest is the query. An empty vector scores 0 with
every other. Scores must fit a long. No queries, or no candidates, give no rows; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockweave.session import settle_table

K = 20
SCALE = 64
CANDIDATE_BLOCK = 8_192
QUERY_BLOCK = 512
# lists are read in stretches that double, up to a length
FIRST_STRETCH = 16
LAST_STRETCH = 128


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v array<long> of the usable rows of `vectors` (vec_id, embedding)."""
    big = F.lit(float("inf"))
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.coalesce(usable, F.lit(False)))
    return rows.select("vec_id", F.transform("embedding", lambda x: F.floor(x * scale).cast("long")).alias("v")).distinct()


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.int64).reshape(len(vectors), -1)


class _Lists:
    """The sorted lists of one block of candidates, which are in the order of their ids."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows
        up = np.argsort(rows, axis=0, kind="stable").T.astype(np.int32)
        self.ends = np.stack([up[:, ::-1], up])  # from the largest, from the smallest
        self.values = np.stack([np.take_along_axis(rows.T, e, axis=1) for e in self.ends])

    def top(self, query: np.ndarray, k: int, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best, by score and then place; places in `skip` are left out."""
        n = len(self.rows)
        met = np.zeros(n, bool)
        met[skip] = True
        dims = np.flatnonzero(query)
        if not len(dims):
            places = np.flatnonzero(~met)[:k]
            return places, np.zeros(len(places), np.int64)
        weights, side = query[dims], (query[dims] < 0).astype(int)
        places, scores = np.zeros(0, np.int64), np.zeros(0, self.rows.dtype)
        depth, stretch = 0, FIRST_STRETCH
        while depth < n:
            upto = min(n, depth + stretch)
            fresh = np.zeros(n, bool)
            fresh[self.ends[side, dims, depth:upto].ravel()] = True
            found = np.flatnonzero(fresh & ~met)
            met[found] = True
            places = np.concatenate([places, found])
            scores = np.concatenate([scores, self.rows[found] @ query])
            if len(scores) > k:  # ties with the kth score stay until they are ordered
                able = scores >= np.partition(scores, -k)[-k]
                places, scores = places[able], scores[able]
            best = np.lexsort((places, -scores))[:k]
            places, scores = places[best], scores[best]
            bound = (weights * self.values[side, dims, upto - 1]).sum()
            if met.all() or len(places) == k and scores[-1] > bound:
                break
            depth, stretch = upto, min(2 * stretch, LAST_STRETCH)
        return places, scores


def _search(k: int):
    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list[np.ndarray]] = {"query_id": [], "vec_id": [], "score": []}
        if len(candidates) and len(queries):
            candidates = candidates.sort_values("vec_id", kind="stable")
            ids, rows, asked = candidates["vec_id"].to_numpy(), _matrix(candidates["v"]), _matrix(queries["v"])
            # the narrowest type in which every sum is exact
            largest = rows.shape[1] * max(1.0, float(np.abs(rows).max(initial=0))) * max(1.0, float(np.abs(asked).max(initial=0)))
            kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else np.int64
            lists = _Lists(rows.astype(kind))
            for query, vector in zip(queries["vec_id"].tolist(), asked.astype(kind)):
                own = np.arange(np.searchsorted(ids, query), np.searchsorted(ids, query, side="right"))
                places, scores = lists.top(vector, k, own)
                found = np.full(len(places), query), ids[places], scores.astype(np.int64)
                for column, values in zip(out.values(), found):
                    column.append(values)
        return pd.DataFrame({c: np.concatenate([np.zeros(0, np.int64), *parts]) for c, parts in out.items()})

    return run


def top_k(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best inner products of every row where `is_query` holds."""
    rows = settle_table(quantized(vectors, scale).withColumn("dim", F.size("v")), "topk-vectors")
    asked = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"), F.min_by("dim", "v").alias("dim"))
    asked = settle_table(asked, "topk-queries")
    blocks = max(1, -(-rows.count() // CANDIDATE_BLOCK))
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))

    def dealt(part: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias(own)
        return part.select("vec_id", "v", "dim", block, F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other))

    keys = ("dim", "block", "query_block")
    left = dealt(rows, "block", blocks, "query_block", query_blocks).groupBy(*keys)
    right = dealt(asked, "query_block", query_blocks, "block", blocks).groupBy(*keys)
    found = left.cogroup(right).applyInPandas(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
