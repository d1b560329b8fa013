"""The keys that existing products own, kept between imports, so that a small feed does not re-key the catalog.

A `KeyedStore` holds three tables. `claims` has one row per existing product (origin, id) with its array of (rule,
key); `owners` has the first product per (rule, key), which is all that matching asks for; `state` remembers
which version of a source the index has seen. A change of some products rewrites the buckets of their
claims and of their old and new keys. Only a key whose first owner leaves has to look for the next one in
the stored claims, which are read, not computed. A key that a third of the products share is one row in
`owners`, and its claims lie in the buckets of their products.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.operators.feed import existing_keys, first_owners
from stockweave.session import settle
from stockweave.sources.sinks import drift
from stockweave.sources.versions import KeyedStore

KEYS = {"claims": ("origin", "id"), "owners": ("rule", "key"), "state": ("name",)}
_STATE = "name string, version long"
_ID, _KEY = ["origin", "id"], ["rule", "key"]


class IndexMoved(RuntimeError):
    """Another writer changed the same products or the state meanwhile: look again."""


def _entries(claims: DataFrame) -> DataFrame:
    return claims.select(*_ID, F.inline("keys"))


def build(store: KeyedStore, base: DataFrame, state: dict[str, int] | None = None) -> int:
    """Index the rows of `feed.match_base`; (origin, id) is unique, a NULL id owns nothing."""
    claims = settle(existing_keys(base))
    seen = base.sparkSession.createDataFrame(list((state or {}).items()), _STATE)
    return store.create({"claims": claims, "owners": _owners(_entries(claims)), "state": seen})


def _owners(entries: DataFrame) -> DataFrame:
    return first_owners(entries).select(*_KEY, "first.origin", "first.id")


def seen(store: KeyedStore, name: str) -> int:
    """The version of a source the index reflects, 0 when it has seen none."""
    return store.read("state").filter(F.col("name") == name).agg(F.max("version").alias("v")).first()["v"] or 0


def owners_of(store: KeyedStore) -> Callable[[DataFrame], DataFrame]:
    """What `feed.classify_feed_with` asks: the first owners of the keys of a feed, from the buckets of these keys."""

    def lookup(asked: DataFrame) -> DataFrame:
        wanted = asked.select(*_KEY).distinct()
        buckets = store.touched({"owners": wanted})["owners"]
        owners = store.read("owners", buckets=buckets)
        return owners.select(*_KEY, F.struct("origin", "id").alias("first"))

    return lookup


def update(
    store: KeyedStore, rows: DataFrame, gone: DataFrame | None = None, state: tuple[str, int, int] | None = None
) -> int:
    """Products that came or changed (`rows`, with origin) and products that left (`gone`: origin, id), as one version.

    `state` is (source, version seen before, version seen then); `IndexMoved` if the index has seen another one.
    """
    fresh = settle(existing_keys(rows))
    ids = fresh.select(*_ID)
    ids = settle((ids if gone is None else ids.unionByName(gone.select(*_ID))).distinct())
    names = ids.sparkSession.createDataFrame([(state[0],)] if state else [], "name string")
    while True:
        near = store.read("claims", buckets=store.touched({"claims": ids})["claims"])
        known = _entries(near.join(ids, _ID, "left_semi")).unionByName(_entries(fresh))
        known = settle(known.select(*_KEY).distinct())

        def apply(old: dict[str, DataFrame]) -> dict[str, DataFrame]:
            before = _entries(old["claims"].join(ids, _ID, "left_semi"))
            if not before.join(known, _KEY, "left_anti").isEmpty():
                raise IndexMoved("claims")
            found = {
                "claims": old["claims"].join(ids, _ID, "left_anti").unionByName(fresh),
                "owners": _new_owners(store, old["owners"], _entries(fresh), ids),
            }
            return found | ({"state": _new_state(old["state"], state)} if state else {})

        try:
            return store.change({"claims": ids, "owners": known} | ({"state": names} if state else {}), apply)
        except IndexMoved as error:
            if str(error) != "claims":
                raise


def _new_owners(store: KeyedStore, owners: DataFrame, fresh: DataFrame, ids: DataFrame) -> DataFrame:
    """First owners of the touched buckets once the products `ids` claim `fresh` and nothing else."""
    # owners that changed but still claim the key stay; the others leave keys without a first owner
    lost = owners.join(ids, _ID, "left_semi").join(fresh, [*_ID, *_KEY], "left_anti")
    if lost.isEmpty():
        return _owners(owners.select(*_ID, *_KEY).unionByName(fresh))
    lost = settle(lost.select(*_KEY))
    stay = owners.join(lost, _KEY, "left_anti").select(*_ID, *_KEY)
    heirs = _entries(store.read("claims")).join(lost, _KEY, "left_semi").join(ids, _ID, "left_anti")
    return _owners(stay.unionByName(heirs.select(*_ID, *_KEY)).unionByName(fresh))


def _new_state(old: DataFrame, state: tuple[str, int, int]) -> DataFrame:
    name, before, after = state
    found = old.filter(F.col("name") == name).agg(F.max("version").alias("v")).first()["v"] or 0
    if found != before:
        raise IndexMoved("state")
    changed = old.sparkSession.createDataFrame([(name, after)], _STATE)
    return old.filter(F.col("name") != name).unionByName(changed)


def follow(store: KeyedStore, origin: int, old: DataFrame, new: DataFrame, state: tuple[str, int, int]) -> int:
    """Bring the index from one version of a source to the next: only rows that differ are keyed."""
    moved = settle(drift(new, old))
    rows = moved.filter("side = 'missing'").drop("side", "copies")
    left = moved.filter("side = 'stale'").select("id").join(rows.select("id"), "id", "left_anti")
    return update(store, rows.withColumn("origin", F.lit(origin)), left.select(F.lit(origin).alias("origin"), "id"), state)
