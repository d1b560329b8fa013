"""Catalog maintenance over the part and order line tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from stockweave.operators import maintain as U
from stockweave.plans import views as V
from stockweave.plans.views import with_views
from stockweave.session import scratch_path
from stockweave.sources.sinks import drift as drift_between
from stockweave.sources.sinks import drift_by_digest as digest_drift
from stockweave.sources.tables import load_table
from stockweave.sources.versions import KeyedStore

NEW_IDS = 10_000_000


def _products(spark, d):
    return V.products(spark, d).select("id", "name", "price_minor", "brand")


def _incoming(spark, d):
    """Large sizes come back dearer; the smallest come in as new products."""
    rows = load_table(spark, d, "part").filter("p_size >= 40 OR p_size = 1")
    price = F.round(F.col("p_retailprice") * 110).cast("bigint")
    return rows.select(
        (F.col("p_partkey") + F.when(F.col("p_size") == 1, F.lit(NEW_IDS)).otherwise(F.lit(0))).alias("id"),
        F.col("p_name").alias("name"),
        price.alias("price_minor"),
    )


def upsert_products(spark, d):
    """Brands are not in the incoming rows and keep their value."""
    return U.upsert(_products(spark, d), _incoming(spark, d))


def activate_products(spark, d):
    tables = U.activate(
        _products(spark, d),
        V.source_products(spark, d).select("id"),
        V.unavailable(spark, d),
        V.retired(spark, d),
        _incoming(spark, d),
    )
    return _ids(tables)


def _ids(tables):
    """All tables as (table, id)."""
    parts = [
        rows.select(F.lit(name).alias("table"), F.col("product_id" if name == "retired" else "id").alias("id"))
        for name, rows in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _records(spark, d):
    """All parts above a price, as rejected."""
    return load_table(spark, d, "part").filter("p_retailprice >= 990").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("title"),
        F.lit(None).cast("string").alias("source_url"),
        F.array().cast("array<string>").alias("failure_reasons"),
        "p_partkey",
    )


def retire_products(spark, d):
    """Retire all parts above a price; those with returned lines stay as rows."""
    records, retired = _records(spark, d).drop("p_partkey"), _retired(spark, d)
    sold = load_table(spark, d, "lineitem").filter("l_returnflag = 'R' AND l_quantity >= 45")
    tables = U.retire(
        _products(spark, d),
        V.source_products(spark, d).select("id"),
        V.unavailable(spark, d),
        retired,
        sold.select(F.col("l_partkey").alias("product_id")),
        records,
        "2026-02-02",
    )
    return _ids(tables)


def _order_products(spark, d):
    lines = load_table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier"),
        "l_returnflag",
    )
    keys = ["order_id", "product_id"]
    base = lines.filter("l_returnflag <> 'R'").groupBy(*keys).agg(F.min("supplier").alias("supplier"))
    return base, lines.filter("l_returnflag = 'R'").select(*keys, "supplier")


def insert_if_absent(spark, d):
    """Returned lines arrive as new order products; keys that exist stay as they are."""
    base, incoming = _order_products(spark, d)
    return U.insert_if_absent(base, incoming, ["order_id", "product_id"], order="supplier")


def insert_items_if_matching(spark, d):
    """Lines enter when the stored header has the hash they were made for; large ones are stored already.

    Every line comes twice, the second time with another quantity: the first stays.
    """
    orders = load_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("request_hash")
    )
    lines = (
        load_table(spark, d, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"))
        .agg(F.min("l_linestatus").alias("request_hash"), F.max("l_quantity").cast("bigint").alias("quantity"))
    )
    base = lines.filter("quantity >= 45").select("order_id", "product_id", "quantity")
    again = lines.withColumns({"quantity": F.col("quantity") + 100, "delivery": F.lit(2)})
    twice = lines.withColumn("delivery", F.lit(1)).unionByName(again)
    return U.insert_items_if_matching(base, twice, orders, "delivery", ("order_id", "product_id"))


def _drifted(spark, d):
    """The catalog, and a stored copy in which some prices are old and some rows are gone."""
    new = _products(spark, d)
    old = new.filter("brand <> 'Brand#7'").withColumn(
        "price_minor", F.when(F.col("brand") == "Brand#8", F.lit(1).cast("bigint")).otherwise(F.col("price_minor"))
    )
    return new, old


def drift(spark, d):
    return drift_between(*_drifted(spark, d))


def _retired(spark, d):
    return V.retired(spark, d).select(
        "product_id",
        F.lit("").alias("name"),
        F.lit(None).cast("string").alias("source_url"),
        F.array(F.lit("X")).alias("failure_reason"),
        F.lit("2026-01-01").cast("timestamp").alias("retired_at"),
    )


def _store(spark, d):
    """The catalog tables as a keyed store of one version."""
    store = KeyedStore(spark, scratch_path(spark, "catalog"), U.CATALOG_KEYS, buckets=16)
    rows = (_products(spark, d), V.source_products(spark, d).select("id"), V.unavailable(spark, d), _retired(spark, d))
    store.create(dict(zip(U.CATALOG_KEYS, rows)))
    return store


def upsert_stored(spark, d):
    """The upsert in two runs, of odd and of even ids, each rewriting its buckets."""
    store = _store(spark, d)
    for part in ("id % 2 = 1", "id % 2 = 0"):
        U.upsert_stored(store, "products", _incoming(spark, d).filter(part))
    return store.read("products")


def activate_stored(spark, d):
    store = _store(spark, d)
    U.activate_stored(store, _incoming(spark, d))
    return _ids({name: store.read(name) for name in store.keys})


def retire_stored(spark, d):
    store = _store(spark, d)
    sold = load_table(spark, d, "lineitem").filter("l_returnflag = 'R' AND l_quantity >= 45")
    sold = sold.select(F.col("l_partkey").alias("product_id"))
    for part in ("p_partkey % 3 = 0", "p_partkey % 3 <> 0"):
        U.retire_stored(store, sold, _records(spark, d).filter(part).drop("p_partkey"), "2026-02-02")
    return _ids({name: store.read(name) for name in store.keys})


def insert_stored(spark, d):
    """Returned lines enter a store of order products, in two runs."""
    base, incoming = _order_products(spark, d)
    store = KeyedStore(spark, scratch_path(spark, "order-products"), {"lines": ("order_id", "product_id")}, buckets=16)
    store.create({"lines": base})
    for part in ("order_id % 2 = 0", "order_id % 2 = 1"):
        U.insert_if_absent_stored(store, "lines", incoming.filter(part), "supplier")
    return store.read("lines")


def drift_by_digest(spark, d):
    """`drift` over checksums: the old table is stored, the new one read once."""
    new, old = _drifted(spark, d)
    store = KeyedStore(spark, scratch_path(spark, "digests"), {"products": ("id",)}, buckets=64)
    store.create({"products": old})
    return digest_drift(store, "products", new)


QUERIES = {
    "upsert_stored": upsert_stored,
    "activate_stored": activate_stored,
    "retire_stored": retire_stored,
    "insert_stored": insert_stored,
    "drift_by_digest": drift_by_digest,
    "upsert_products": upsert_products,
    "activate_products": activate_products,
    "retire_products": retire_products,
    "insert_if_absent": insert_if_absent,
    "insert_items_if_matching": insert_items_if_matching,
    "drift": drift,
}

_INCOMING_SQL = f"""inc AS (SELECT p_partkey + CASE WHEN p_size = 1 THEN {NEW_IDS} ELSE 0 END AS id, p_name AS name,
    CAST(round(p_retailprice * 110) AS BIGINT) AS price_minor FROM part WHERE p_size >= 40 OR p_size = 1)"""

ORACLE = {
    "upsert_products": with_views("p", body=f""", {_INCOMING_SQL}
        SELECT coalesce(inc.id, p.id) AS id, coalesce(inc.name, p.name) AS name,
            coalesce(inc.price_minor, p.price_minor) AS price_minor, p.brand
        FROM p FULL JOIN inc ON inc.id = p.id"""),
    "activate_products": with_views("p", "s", "u", "r", body=f""", {_INCOMING_SQL}
        SELECT 'products' AS "table", coalesce(inc.id, p.id) AS id FROM p FULL JOIN inc ON inc.id = p.id
        UNION ALL SELECT 'source_products', id FROM s WHERE id NOT IN (SELECT id FROM inc)
        UNION ALL SELECT 'unavailable', id FROM u WHERE id NOT IN (SELECT id FROM inc)
        UNION ALL SELECT 'retired', product_id FROM r WHERE product_id NOT IN (SELECT id FROM inc)"""),
    "retire_products": with_views("p", "s", "u", "r", body="""
        , rec AS (SELECT p_partkey AS id FROM part WHERE p_retailprice >= 990),
        sold AS (SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 45)
        SELECT 'products' AS "table", id FROM p
            WHERE NOT (id IN (SELECT id FROM rec) AND id NOT IN (SELECT id FROM sold))
        UNION ALL SELECT 'source_products', id FROM s WHERE id NOT IN (SELECT id FROM rec)
        UNION ALL (SELECT 'unavailable', id FROM u UNION SELECT 'unavailable', id FROM p
            WHERE id IN (SELECT id FROM rec) AND id IN (SELECT id FROM sold))
        UNION ALL (SELECT 'retired', product_id FROM r UNION SELECT 'retired', id FROM rec)"""),
    "insert_if_absent": """SELECT l_orderkey AS order_id, l_partkey AS product_id,
            coalesce(min(l_suppkey) FILTER (l_returnflag <> 'R'), min(l_suppkey)) AS supplier
        FROM lineitem GROUP BY 1, 2""",
    "insert_items_if_matching": """SELECT l_orderkey AS order_id, l_partkey AS product_id,
            CAST(max(l_quantity) AS BIGINT) AS quantity
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, o_orderstatus
        HAVING max(l_quantity) >= 45 OR min(l_linestatus) = o_orderstatus""",
    "drift": with_views("p", body="""
        , n AS (SELECT id, name, price_minor, brand FROM p)
        SELECT *, 'missing' AS side, CAST(1 AS BIGINT) AS copies FROM n WHERE brand IN ('Brand#7', 'Brand#8')
        UNION ALL SELECT id, name, CAST(1 AS BIGINT), brand, 'stale', 1 FROM n WHERE brand = 'Brand#8'"""),
}
# the stored forms give the same rows
ORACLE |= {
    "upsert_stored": ORACLE["upsert_products"],
    "activate_stored": ORACLE["activate_products"],
    "retire_stored": ORACLE["retire_products"],
    "insert_stored": ORACLE["insert_if_absent"],
    "drift_by_digest": ORACLE["drift"],
}
