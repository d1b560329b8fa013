import re
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from stockweave.llm import simhash
from tests.llm import cases


def plain_fingerprint(text):
    lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
    found = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 4:
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        known = [k for k in (least.get(root(i)), key) if k is not None]
        least[root(i)] = min(known, default=None)
    return [(key, prints[i], least[root(i)]) for i, (key, _) in enumerate(rows)]


def rows_of(found):
    return Counter((r[0], r[1] & (2**64 - 1), r[2]) for r in found.collect())


def test_odd_rows_match_brute_force(spark):
    docs = cases.with_clashes(cases.documents(spark))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(simhash.near_duplicates(docs)) == Counter(brute(rows))
    assert simhash.near_duplicates(cases.empty(docs)).count() == 0


def test_spark_hash_is_the_shingle_hash(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()
    assert row[0] & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c d", 42)


def random_points(n, seed=0):
    """Random fingerprints, and chains of points a few bits from each other."""
    rng = np.random.default_rng(seed)
    points = rng.integers(0, 2**64, n, dtype=np.uint64)
    for _ in range(6):
        bits = np.uint64(1) << rng.integers(0, 64, (n, 3)).astype(np.uint64)
        points = np.unique(np.concatenate([points, points[:n] ^ np.bitwise_or.reduce(bits, axis=1)]))
    return points


def components(points, pairs):
    parent = {int(p): int(p) for p in points}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[root(a)] = root(b)
    groups = {}
    for p in parent:
        groups.setdefault(root(p), set()).add(p)
    return {frozenset(g) for g in groups.values()}


def forest(spark, points, **options):
    table = spark.createDataFrame(pd.DataFrame({"fp": points.view(np.int64)}))
    links = simhash.link_forest(table, **options).collect()
    pairs = [(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in links]
    assert all((a ^ b).bit_count() <= 4 for a, b in pairs)
    return components(points, pairs)


def all_links(points):
    pairs = []
    for i, p in enumerate(points):
        near = np.flatnonzero(np.bitwise_count(points[i + 1 :] ^ p) <= 4) + i + 1
        pairs += [(int(p), int(points[j])) for j in near]
    return components(points, pairs)


def test_forest_connects_what_links_connect(spark):
    points = random_points(200)
    assert forest(spark, points) == all_links(points)


def test_large_cells_are_walked_and_cut(spark, monkeypatch):
    rng = np.random.default_rng(2)
    masks = np.uint64(1) << rng.integers(0, 12, (900, 2)).astype(np.uint64)
    points = np.unique(np.uint64(0x0123456789ABCDEF) ^ np.bitwise_or.reduce(masks, axis=1) ^ rng.integers(0, 2**8, 900, dtype=np.uint64))
    wanted = all_links(points)
    monkeypatch.setattr(simhash, "WALK_ROWS", 16)
    assert forest(spark, points) == wanted
    assert forest(spark, points, cell_rows=40) == wanted


def test_a_forest_is_no_list_of_pairs(spark):
    points = np.arange(32, dtype=np.uint64)  # 496 pairs, most of them linked
    table = spark.createDataFrame(pd.DataFrame({"fp": points.view(np.int64)}))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 31 <= simhash.link_forest(table).count() <= 31 * tasks


def test_distance_bound():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 2**64, (2, 500), dtype=np.uint64)
    bound = np.bitwise_count(simhash.embed(a) ^ simhash.embed(b))
    counts = [[bin(x >> 2 * s & 3).count("1") for s in range(32)] for x in (int(a[0]), int(b[0]))]
    assert bound[0] == sum(abs(p - q) for p, q in zip(*counts))
    assert (bound <= np.bitwise_count(a ^ b)).all()


def test_star_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    found = {r.node: r.root for r in simhash.star_components(links).collect()}
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_long_texts_in_pieces(monkeypatch):
    text = " ".join(str(i * i % 977) for i in range(5000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PIECE_BYTES", 64)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


def test_one_of_each_keeps_the_smallest_id(spark):
    # without the row that gives an id another text
    docs = cases.with_clashes(cases.documents(spark)).filter("doc_id IS NULL OR n_chars <> 1")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    components = {c for _, _, c in brute(rows)}  # a null one has a single row here
    assert Counter(r.doc_id for r in kept.collect()) == Counter(components)
