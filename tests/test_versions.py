"""Versions, keyed stores and checksums."""

import pytest
from pyspark.sql import functions as F

from stockweave.operators import maintain as U
from stockweave.sources import sinks, versions
from stockweave.sources.versions import KeyedStore

SCHEMA = "id long, name string, price_minor long"


def items(spark, ids, name="n"):
    return spark.createDataFrame([(i, f"{name}{i}", 10 * i) for i in ids], SCHEMA)


@pytest.fixture
def store(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "store"), {"items": ("id",), "marks": ("id",)}, buckets=8)
    store.create({"items": items(spark, range(100)), "marks": items(spark, [1, 2])})
    return store


def names(frame):
    return {r.id: r.name for r in frame.collect()}


def test_two_publishers_lose_neither(spark, tmp_path, monkeypatch):
    """The second publisher claims its version while the first one is between writing and claiming."""
    root, claim = str(tmp_path / "out"), versions.claim
    sinks.publish(spark, {"t": items(spark, [1])}, root)
    other = []

    def interrupted(spark, root, version, what):
        if not other:
            other.append(None)
            other[0] = sinks.publish(spark, {"t": items(spark, [2])}, root)
        return claim(spark, root, version, what)

    monkeypatch.setattr(versions, "claim", interrupted)
    assert sinks.publish(spark, {"t": items(spark, [3])}, root) == 3 and other == [2]
    found = [set(names(sinks.read_published(spark, root, "t", v))) for v in (1, 2, 3)]
    assert found == [{1}, {2}, {3}] and sinks.latest_version(spark, root) == 3
    assert not claim(spark, root, 3, {"folder": "x"}) and sinks.latest_version(spark, root) == 3


def test_untouched_buckets_keep_their_files(spark, store):
    before = store.entries()
    incoming = items(spark, [3, 1000], "new")
    assert U.upsert_stored(store, "items", incoming) == 2
    after, touched = store.entries(), store.touched({"items": incoming})["items"]
    assert {k for k in after if after[k] != before.get(k)} == {("items", b) for b in touched} and len(touched) <= 2
    found = names(store.read("items"))
    assert found == {i: f"n{i}" for i in range(100)} | {3: "new3", 1000: "new1000"}
    assert names(store.read("items", version=1)) == {i: f"n{i}" for i in range(100)}
    files = set(store.read("items").inputFiles())
    assert len(files & set(store.read("items", version=1).inputFiles())) == len(before) - 2 - len(touched)


def test_changes_that_meet(spark, store, monkeypatch):
    """Another change lands first: in other buckets it is kept as it is, in the same one the change is computed again."""
    claim, applied = versions.claim, []
    same = [i for i in range(2000, 2100) if store.touched({"items": items(spark, [i])}) == store.touched({"items": items(spark, [5])})][0]
    away = [i for i in range(2000, 2100) if store.touched({"items": items(spark, [i])}) != store.touched({"items": items(spark, [5])})][0]
    for other, runs in ((away, 1), (same, 2)):
        state, applied[:] = [], []

        def interrupted(spark, root, version, what, other=other, state=state):
            if not state:
                state.append(True)
                U.upsert_stored(store, "items", items(spark, [other], "other"))
            return claim(spark, root, version, what)

        def change(old):
            applied.append(True)
            return {"items": U.upsert(old["items"], items(spark, [5], f"mine{other}-"))}

        monkeypatch.setattr(versions, "claim", interrupted)
        store.change({"items": items(spark, [5])}, change)
        monkeypatch.setattr(versions, "claim", claim)
        found = names(store.read("items"))
        assert found[other] == f"other{other}" and found[5] == f"mine{other}-5" and len(applied) == runs
    assert store.version() == 5


def test_rows_outside_the_changed_buckets_are_refused(spark, store):
    with pytest.raises(ValueError, match="outside"):
        store.change({"items": items(spark, [5])}, lambda old: {"items": old["items"].unionByName(items(spark, range(500, 600)))})
    assert store.version() == 1


def test_emptied_buckets_and_tables(spark, store):
    store.change({"marks": items(spark, [1, 2])}, lambda old: {"marks": old["marks"].filter("false")})
    assert store.read("marks").collect() == [] and store.read("marks").columns == ["id", "name", "price_minor"]
    store.change({"marks": items(spark, [7])}, lambda old: {"marks": items(spark, [7])})
    assert names(store.read("marks")) == {7: "n7"}
    with pytest.raises(FileNotFoundError):
        KeyedStore(spark, store.root + "-none", store.keys).read("items")


def test_insert_and_ledger_on_a_store(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "lines"), {"lines": ("order_id", "line_no")}, buckets=4)
    schema = "order_id string, line_no int, quantity int, at int"
    store.create({"lines": spark.createDataFrame([("a", 1, 1, 0), ("b", 1, 2, 0)], schema)})
    again = spark.createDataFrame([("a", 1, 9, 1), ("a", 2, 5, 2), ("a", 2, 6, 1)], schema)
    U.insert_if_absent_stored(store, "lines", again, "at")
    assert {(r.order_id, r.line_no): r.quantity for r in store.read("lines").collect()} == {("a", 1): 1, ("a", 2): 6, ("b", 1): 2}


def test_drift_reads_only_buckets_that_differ(spark, store):
    new = items(spark, range(100)).withColumn("name", F.when(F.col("id") == 42, "changed").otherwise(F.col("name")))
    assert store.stale_buckets("items", items(spark, range(100))) == set()
    stale = store.stale_buckets("items", new)
    assert stale == store.touched({"items": items(spark, [42])})["items"] and len(stale) == 1
    found = sinks.drift_by_digest(store, "items", new)
    assert len({f for f in found.inputFiles() if "/data/" in f}) == 1
    assert {(r.id, r.name, r.side) for r in found.collect()} == {(42, "changed", "missing"), (42, "n42", "stale")}
    for other in (new.filter("id < 99"), new.unionByName(items(spark, [5])), new.unionByName(items(spark, [100]))):
        key = lambda r: tuple(r)
        assert sorted(map(key, sinks.drift_by_digest(store, "items", other).collect())) == sorted(
            map(key, sinks.drift(other, store.read("items")).collect())
        )
    assert sinks.drift_by_digest(store, "items", items(spark, range(100))).collect() == []
