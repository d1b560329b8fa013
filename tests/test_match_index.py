"""The kept key index against keys computed from all rows."""

import random

import pytest
from pyspark.sql import functions as F

from stockweave.operators import feed as M
from stockweave.operators import match_index
from stockweave.plans import jobs
from stockweave.schemas import IMAGE_EVIDENCE, PAGE_EVIDENCE, PRODUCT
from stockweave.sources import sinks
from stockweave.sources.versions import KeyedStore
from tests.test_feed import evidence, feed_of, variant

BASE = "origin int, id string, name string, brand string, canonical_url string, source_store string, source_product_id string"


def base(spark, rows):
    return spark.createDataFrame([(o, i, *rest) for (o, i), rest in rows.items()], BASE)


def product(rng):
    url = rng.choice(["https://a.example/hot", f"https://a.example/{rng.randrange(12)}", None])
    return (f"N{rng.randrange(6)}", rng.choice(["B", ""]), url, rng.choice(["S", None]), str(rng.randrange(8)))


def owners(frame):
    return {(r.rule, r.key): tuple(r.first) for r in frame.collect()}


def test_index_equals_all_rows_over_changes(spark, tmp_path):
    """One URL belongs to a third of the products; owners leave, change, come back before others."""
    rng = random.Random(5)
    rows = {(rng.randrange(2), f"p{i}"): product(rng) for i in range(40)}
    store = KeyedStore(spark, str(tmp_path / "index"), match_index.KEYS, buckets=4)
    match_index.build(store, base(spark, rows))
    for turn in range(3):
        first = min(k for k, v in rows.items() if v[2] and v[2].endswith("hot"))
        gone = {first, *rng.sample(sorted(rows), 4)}
        changed = {k: product(rng) for k in rng.sample(sorted(set(rows) - gone), 5)} | {(0, f"a{turn}"): product(rng)}
        rows = {k: v for k, v in rows.items() if k not in gone} | changed
        match_index.update(store, base(spark, changed), spark.createDataFrame(sorted(gone), "origin int, id string"))
        wanted = owners(M.base_keys(base(spark, rows)))
        asked = M.existing_keys(base(spark, rows)).select(F.inline("keys"))
        assert owners(match_index.owners_of(store)(asked)) == wanted
        stored = store.read("owners").select("rule", "key", F.struct("origin", "id").alias("first"))
        assert owners(stored) == wanted  # no owner of a key that nobody claims is left


def test_a_small_change_keeps_other_buckets(spark, tmp_path):
    rows = {(0, f"p{i}"): (f"N{i}", "B", f"https://a.example/{i}", "S", str(i)) for i in range(300)}
    store = KeyedStore(spark, str(tmp_path / "index"), match_index.KEYS, buckets=64)
    match_index.build(store, base(spark, rows))
    before = store.entries()
    match_index.update(store, base(spark, {(0, "p7"): ("other", "B", "https://a.example/7", "S", "7")}))
    after = store.entries()
    moved = {k for k in before.keys() | after.keys() if before.get(k) != after.get(k)}
    # its claims, its old and its new product key; the buckets of its unchanged keys are written again
    assert {n for n, _ in moved} == {"claims", "owners"} and len(moved) <= 6
    asked = spark.createDataFrame([(M.OWN_ID, "p7")], "rule int, key string")
    files = match_index.owners_of(store)(asked).inputFiles()
    assert 1 <= len(files) < 5
    assert match_index.owners_of(store)(asked.limit(0)).count() == 0
    # nothing at all, rows without id, a product that is not there
    match_index.update(store, base(spark, {(0, None): ("x", "y", "z", "s", "1")}), spark.createDataFrame([(1, "no")], "origin int, id string"))
    assert store.entries().keys() == after.keys()


def test_empty_index(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "index"), match_index.KEYS, buckets=4)
    match_index.build(store, base(spark, {}), {"ledger": 3})
    assert match_index.seen(store, "ledger") == 3 and match_index.seen(store, "other") == 0
    asked = spark.createDataFrame([(M.URL, "https://a.example/1")], "rule int, key string")
    assert match_index.owners_of(store)(asked).count() == 0
    with pytest.raises(match_index.IndexMoved):
        match_index.update(store, base(spark, {}), None, ("ledger", 2, 4))
    match_index.update(store, base(spark, {(1, "p"): ("n", "b", "https://a.example/1", "s", "1")}), None, ("ledger", 3, 4))
    assert match_index.seen(store, "ledger") == 4
    assert [r.first.id for r in match_index.owners_of(store)(asked).collect()] == ["p"]


def test_import_job_over_the_index_equals_the_job_over_all_rows(spark, tmp_path):
    """Three imports; the index follows the ledger, also over a version it has not seen."""
    catalog = spark.createDataFrame([], PRODUCT)
    store = KeyedStore(spark, str(tmp_path / "index"), match_index.KEYS, buckets=4)
    match_index.build(store, M.match_base(catalog, jobs.published_ledger(spark, str(tmp_path / "none"))))
    plain, kept = str(tmp_path / "plain"), str(tmp_path / "kept")
    feeds = ([variant(1), variant(2)], [variant(2), variant(3)], [variant(1), variant(4, {"canonical_url": "https://www.shop.example/p/3"})])
    for n, rows in enumerate(feeds):
        items, pages, images = map(list, zip(*rows))
        inputs = (feed_of(spark, items), evidence(spark, pages, PAGE_EVIDENCE), evidence(spark, images, IMAGE_EVIDENCE))
        jobs.import_job(spark, *inputs, catalog, plain)
        jobs.import_job(spark, *inputs, catalog, kept, index=None if n == 1 else store)
        for name in ("ledger", "retire_records"):
            assert sinks.read_published(spark, plain, name).collect() == sinks.read_published(spark, kept, name).collect()
    assert match_index.seen(store, "ledger") == 2
    report = lambda root: sorted(map(str, spark.read.json(f"{root}/report/products").collect()))
    assert report(plain) == report(kept)
    jobs.follow_ledger(spark, store, kept)
    assert match_index.seen(store, "ledger") == 3
