import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockweave.llm import codes


def brute(rows, parts, entries, rounds, scale=256):
    """Codes, errors and codebooks of rows (vec_id, embedding, label), every distance taken."""
    kept = [(i, tuple(math.floor(scale * float(x)) for x in v), label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = len(kept[0][1])
    limits = [i * d // parts for i in range(parts + 1)]
    whole = [r for r in kept if len(r[1]) == d]
    books = [[list(r[1][a:b]) for r in whole[:entries]] for a, b in zip(limits, limits[1:])]

    def nearest(part, x):
        return min((sum((p - q) ** 2 for p, q in zip(x, c)), j) for j, c in enumerate(books[part]))

    for _ in range(rounds):
        codes_ = [[nearest(p, r[1][limits[p] : limits[p + 1]])[1] for p in range(parts)] for r in whole]
        for p in range(parts):
            for j in range(len(books[p])):
                mine = [r[1][limits[p] : limits[p + 1]] for r, c in zip(whole, codes_) if c[p] == j]
                if mine:
                    books[p][j] = [sum(x) // len(mine) for x in zip(*mine)]
    out = []
    for i, v, label in kept:
        if len(v) != d:
            out.append((i, label, None, None))
            continue
        near = [nearest(p, v[limits[p] : limits[p + 1]]) for p in range(parts)]
        out.append((i, label, tuple(j for _, j in near), sum(e for e, _ in near)))
    numbers = ",".join(str(x) for part in books for entry in part for x in entry)
    return Counter(out), hashlib.sha256(numbers.encode()).hexdigest()


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit("clash") for c in ("v", "code", "error", "stamp")})


def vectors(n, d, seed=0, centers=12, spread=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centers, d))
    x = middle[rng.integers(0, centers, n)] + spread * rng.normal(size=(n, d))
    return [(i, [float(np.float32(v)) for v in row], int(i) % 3) for i, row in enumerate(x)]


def found(spark, rows, **options):
    coded, books = codes.compress(table(spark, rows), **options)
    return Counter((r.vec_id, r.label, r.code and tuple(r.code), r.error) for r in coded.collect()), books.digest()


@pytest.mark.parametrize(("parts", "entries", "rounds", "d"), [(4, 16, 2, 8), (3, 10, 5, 7), (2, 1, 1, 4), (4, 40, 0, 8)])
def test_against_brute_force(spark, parts, entries, rounds, d):
    rows = vectors(300, d)
    assert found(spark, rows, parts=parts, entries=entries, rounds=rounds) == brute(rows, parts, entries, rounds)


def test_ties_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) / 256 for x in rng.integers(-2, 3, 6)], None if i % 5 == 0 else 1) for i in range(120)]
    rows += [(None, [0.0] * 6, 2), (3, None, 1), (4, [nan] * 6, 1), (5, [None] * 6, 1), (6, [inf] * 6, 1), (7, [1.0], 1), (8, [], None)]
    rows += rows[:10]
    assert found(spark, rows, parts=3, entries=16, rounds=3) == brute(rows, 3, 16, 3)


def test_empty_and_few_rows(spark):
    coded, books = codes.compress(table(spark, []))
    assert coded.collect() == [] and books is None
    rows = vectors(5, 32)
    assert found(spark, rows) == brute(rows, 16, 64, 2)


def test_label_error(spark):
    rows = [(i, v, None if i % 4 == 0 else i % 3) for i, v, _ in vectors(60, 4)]
    coded, _ = codes.compress(table(spark, rows), parts=2, entries=4)
    sums = Counter()
    for r in coded.collect():
        sums[r.label] += r.error
    assert all(r.label_error == sums[r.label] for r in codes.with_label_error(coded).collect())


def test_stamped_bounds_pass_over_groups_and_stay_exact():
    """Entries that move to and fro: the net move since the stamp is small, the sum of the moves is not."""
    rng = np.random.default_rng(4)
    start = rng.integers(-4000, 4000, (32, 4))
    x = (start[rng.integers(0, 32, 2000)] + rng.integers(-40, 41, (2000, 4))).astype(np.int64)
    step = rng.integers(-900, 901, start.shape)
    history = [start, start + step, start + step // 64, start + step, start]
    code, bound, stamp, error = codes.PartAssigner(history[:1], 4).first(x)
    taken = []
    for r in range(2, len(history) + 1):
        part = codes.PartAssigner(history[:r], 4)
        code, bound, stamp, error = part.next(x, code, bound, stamp)
        squares = codes._squared(x, history[r - 1])
        assert (code == squares.argmin(axis=1)).all() and (error == squares.min(axis=1)).all()
        # a bound never exceeds the distance to the other entries of its group
        for g in range(8):
            others = np.where(code // 4 == g, code, -1)
            near = np.array([np.sqrt(min(q for j, q in enumerate(row[4 * g : 4 * g + 4], 4 * g) if j != own)) for row, own in zip(squares, others)])
            left = bound[:, g] - part.moved[stamp[:, g], g]
            assert (left <= near + 1e-6).all()
        taken.append(part.taken / (len(x) * 32))
    drifts = sum(np.sqrt(((b - a) ** 2).sum(axis=1)) for a, b in zip(history, history[1:]))
    net = np.sqrt(((history[-1] - history[0]) ** 2).sum(axis=1))
    assert net.max() == 0 < drifts.min()
    assert taken[-1] < 0.5 and set(np.unique(stamp)) - {len(history) - 1}
