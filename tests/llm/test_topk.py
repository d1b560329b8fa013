import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockweave.llm import topk


def brute(rows, k=20):
    usable = {(i, tuple(math.floor(64 * float(x)) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    asked = {}
    for i, v in usable:
        if i % 20 == 0:
            asked[i] = min(v, asked.get(i, v))
    out = []
    for q, v in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q and len(w) == len(v))[:k]
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)]
    return Counter(out)


def search(spark, rows, **options):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit("clash") for c in ("v", "dim", "score")})
    return Counter(map(tuple, topk.top_k(table, F.col("vec_id") % 20 == 0, **options).collect()))


def vectors(n, dims, seed=0, levels=None):
    rng = np.random.default_rng(seed)
    x = rng.integers(-levels, levels + 1, (n, dims)) / 64 if levels else rng.normal(size=(n, dims))
    return [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]


def test_random_vectors(spark):
    assert search(spark, rows := vectors(300, 8)) == brute(rows)


def test_ties_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    assert search(spark, rows := vectors(300, 3, 1, levels=1)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -2.0]), (20, None), (40, [nan, 1.0]), (60, [None, 1.0]), (80, [inf, 0.0]), (None, [1.0, 1.0])]
    rows += [(100, [0.0, 0.0]), (120, [1.0]), (140, []), (160, []), (0, [1.0, -2.0]), (7, [3.0, 3.0]), (7, [2.0, 3.0]), (9, [-1.0, 1.5])]
    rows += [(200, [1e7, 5.0, 2.0]), (201, [1e6, 5.0, 2.0])]
    rows = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert search(spark, rows) == brute(rows)
    assert search(spark, rows[1:3]) == Counter()


@pytest.mark.parametrize("k", [1, 5])
def test_stops_before_the_end(k):
    """One large weight: a few stretches of one list settle the answer."""
    rng = np.random.default_rng(3)
    rows = (rng.normal(size=(4000, 4)) * 64).astype(np.int64).astype(np.float64)
    query = np.array([50.0, -3.0, 0.0, 1.0])
    scores = rows @ query
    best = np.lexsort((np.arange(4000), -scores))[:k]
    lists = topk._Lists(rows)
    read = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray):
                read.append(len(at))
            return np.asarray(self)[at]

    lists.rows = rows.view(Watched)
    places, found = lists.top(query, k, np.array([], np.int64))
    assert places.tolist() == best.tolist() and found.tolist() == scores[best].tolist()
    assert sum(read) < 1000
