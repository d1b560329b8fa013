"""New table versions: upserts, activation, retirement and the ledger of imports.

Every function returns the tables as they are afterwards; `sinks.publish` stores them. The
`_stored` ones apply the same changes to a `KeyedStore`, rewriting only the buckets they touch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.sources.feeds import latest_per_key
from stockweave.sources.versions import KeyedStore

DEFAULT_REASON = "VALIDATION_FAILED"
UNAVAILABLE_REASON = "strict_import_rejected"


def without(rows: DataFrame, key: str, ids: DataFrame, id_column: str) -> DataFrame:
    return rows.join(ids.select(F.col(id_column).alias(key)), key, "left_anti")


def upsert(base: DataFrame, incoming: DataFrame, key: str = "id") -> DataFrame:
    """Incoming rows replace base rows of the same key; columns they lack keep the base value.

    `incoming` holds a key once (see `latest_per_key`).
    """
    kept = without(base, key, incoming, key)
    carried = [c for c in base.columns if c not in incoming.columns]
    if not carried:
        return kept.unionByName(incoming.select(*base.columns))
    old = base.select(key, *carried)
    return kept.unionByName(incoming.join(old, key, "left").select(*base.columns))


def insert_if_absent(base: DataFrame, incoming: DataFrame, keys: list[str], order: Column | str) -> DataFrame:
    """Rows whose key is not there yet; of several new rows with one key the first by `order` stays."""
    columns = base.columns
    first = incoming.groupBy(*keys).agg(F.min_by(F.struct(*columns), order).alias("_first"))
    fresh = first.select(*[F.col("_first")[c].alias(c) for c in columns]).join(base.select(*keys), keys, "left_anti")
    return base.unionByName(fresh)


def insert_items_if_matching(
    base: DataFrame,
    incoming: DataFrame,
    orders: DataFrame,
    order: Column | str,
    keys: tuple[str, ...] = ("order_id", "line_no"),
) -> DataFrame:
    """Lines are only added for a stored header with the same hash.

    `incoming` carries `request_hash`; lines that exist keep their price snapshot, and of
    new lines with one key the first by `order` stays.
    """
    stored = orders.select(F.col("id").alias("order_id"), "request_hash")
    guarded = incoming.join(stored, ["order_id", "request_hash"], "left_semi")
    return insert_if_absent(base, guarded, list(keys), order)


def activate(
    products: DataFrame, source_products: DataFrame, unavailable: DataFrame, retired: DataFrame, incoming: DataFrame
) -> dict[str, DataFrame]:
    """Upsert accepted products and lift every mark that hid them."""
    return {
        "products": upsert(products, incoming.select(*[c for c in products.columns if c in incoming.columns])),
        "source_products": without(source_products, "id", incoming, "id"),
        "unavailable": without(unavailable, "id", incoming, "id"),
        "retired": without(retired, "product_id", incoming, "id"),
    }


def retire(
    products: DataFrame,
    source_products: DataFrame,
    unavailable: DataFrame,
    retired: DataFrame,
    order_items: DataFrame,
    records: DataFrame,
    retired_at,
) -> dict[str, DataFrame]:
    """Take rejected products out; a product that orders refer to keeps its row.

    `records` has product_id, title, source_url, failure_reasons, one row per id.
    Sold ids are made distinct map-side, so a bestseller is one row in the join.
    """
    records = records.filter(F.col("product_id").isNotNull())
    reasons = F.when(F.size("failure_reasons") > 0, F.col("failure_reasons")).otherwise(F.array(F.lit(DEFAULT_REASON)))
    ledger_rows = records.select(
        "product_id",
        F.coalesce("title", F.col("product_id").cast("string")).alias("name"),
        "source_url",
        reasons.alias("failure_reason"),
    )
    since = retired.select("product_id", F.col("retired_at").alias("_since"))
    ledger_rows = ledger_rows.join(since, "product_id", "left").select(
        *ledger_rows.columns, F.coalesce("_since", F.lit(retired_at).cast("timestamp")).alias("retired_at")
    )
    ids = records.select(F.col("product_id").alias("id"))
    sold = order_items.select(F.col("product_id").alias("id")).distinct()
    hit = products.select("id").join(ids, "id", "left_semi")
    kept = hit.join(sold, "id", "left_semi")
    marks = kept.select("id", F.lit(UNAVAILABLE_REASON).alias("reason"))
    return {
        "products": without(products, "id", hit.join(sold, "id", "left_anti"), "id"),
        "source_products": without(source_products, "id", ids, "id"),
        "unavailable": insert_if_absent(unavailable, marks, ["id"], "reason"),
        "retired": without(retired, "product_id", records, "product_id").unionByName(
            ledger_rows.select(*retired.columns)
        ),
    }


# tables of a catalog store, and their keys
CATALOG_KEYS = {"products": ("id",), "source_products": ("id",), "unavailable": ("id",), "retired": ("product_id",)}


def _keyed(store: KeyedStore, ids: DataFrame, names) -> dict[str, DataFrame]:
    return {name: ids.select(F.col("id").alias(store.keys[name][0])) for name in names}


def upsert_stored(store: KeyedStore, name: str, incoming: DataFrame) -> int:
    key = store.keys[name][0]
    return store.change({name: incoming}, lambda old: {name: upsert(old[name], incoming, key)})


def insert_if_absent_stored(store: KeyedStore, name: str, incoming: DataFrame, order: Column | str) -> int:
    keys = list(store.keys[name])
    return store.change({name: incoming}, lambda old: {name: insert_if_absent(old[name], incoming, keys, order)})


def activate_stored(store: KeyedStore, incoming: DataFrame) -> int:
    """`activate` on the buckets of the incoming ids, all four tables in one version."""
    touched = _keyed(store, incoming.select("id"), CATALOG_KEYS)
    return store.change(touched, lambda old: activate(*[old[name] for name in CATALOG_KEYS], incoming))


def retire_stored(store: KeyedStore, order_items: DataFrame, records: DataFrame, retired_at) -> int:
    """`retire` on the buckets of the rejected ids, all four tables in one version."""
    records = records.filter(F.col("product_id").isNotNull())
    touched = _keyed(store, records.select(F.col("product_id").alias("id")), CATALOG_KEYS)
    # lines are asked for these ids only; a bestseller is one row
    sold = order_items.select("product_id").join(records.select("product_id"), "product_id", "left_semi").distinct()
    return store.change(touched, lambda old: retire(*[old[name] for name in CATALOG_KEYS], sold, records, retired_at))


def merge_ledger_stored(store: KeyedStore, accepted: DataFrame, results: DataFrame, name: str = "ledger") -> int:
    return store.change({name: accepted}, lambda old: {name: merge_ledger(old[name], accepted, results)})


def merge_ledger(ledger: DataFrame, accepted: DataFrame, results: DataFrame) -> DataFrame:
    """Accepted rows replace ledger rows; an id last reported EXISTING keeps its row."""
    last = latest_per_key(results.select("pos", "product_id", "status"), "product_id", "pos")
    existing = last.filter("status = 'EXISTING'").select(F.col("product_id").alias("id"))
    protected = ledger.select("id").join(existing, "id", "left_semi")
    incoming = latest_per_key(accepted, "id", "pos").join(protected, "id", "left_anti")
    return upsert(ledger, incoming.select(*ledger.columns))


def retire_records(results: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rejected rows that are not active: a failed update never removes a good product."""
    rejected = results.filter(F.col("status") == "REJECTED")
    return rejected.join(ledger.select(F.col("id").alias("product_id")), "product_id", "left_anti")


def import_counts(catalog: DataFrame, ledger: DataFrame, retired: DataFrame) -> DataFrame:
    count = lambda rows: rows.agg(F.count("*")).scalar()
    return catalog.sparkSession.range(1).select(
        (count(catalog) + count(ledger)).alias("final_catalog_count"),
        count(ledger).alias("active_imported_count"),
        count(retired).alias("retired_count"),
    )
