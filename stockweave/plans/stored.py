"""Queries over stored forms: bucketed orders, roll-ups, the search index, the published catalog files."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from stockweave.operators import catalog as C
from stockweave.operators import cleaning as L
from stockweave.operators import orders as O
from stockweave.operators import quality as Q
from stockweave.operators import listing, rollups, search_index
from stockweave.plans import checkout, cleaning, sales
from stockweave.plans import views as V
from stockweave.plans.cleaning import raw_parts
from stockweave.session import scratch_path
from stockweave.sources import catalog_csv, order_store, sinks
from stockweave.sources.tables import load_table


def _stored_orders(spark, d, items):
    name, path = f"stored_{uuid.uuid4().hex}", scratch_path(spark, "orders")
    order_store.store_orders(V.orders(spark, d), items, name, path, buckets=16)
    return order_store.open_orders(spark, name)


def order_readback_bucketed(spark, d):
    lines = V.items(spark, d).withColumns({"size": F.lit(""), "color": F.lit("")})
    order = [F.col(c).asc() for c in ("product_id", "quantity", "unit_price_minor")]
    orders, items = _stored_orders(spark, d, O.number_lines(lines, order))
    return order_store.read_orders(orders, items).select(
        "order_id", "line_no", "product_id", "quantity", "unit_price_minor", "total_minor", "source", "currency"
    )


def reconcile_totals_bucketed(spark, d):
    return Q.reconcile_totals(*_stored_orders(spark, d, V.items(spark, d)))


def orders_without_lines_bucketed(spark, d):
    orders, items = _stored_orders(spark, d, V.items(spark, d))
    return Q.orphans(orders, items, "id", "order_id").select("id", "total_minor")


def _rolled_up(spark, d, compact: bool):
    """Orders in three batches, by order number modulo three; the second one comes twice."""
    root = scratch_path(spark, "rollup")
    orders, items = V.orders(spark, d), V.items(spark, d, snapshot=True)
    for batch, part in enumerate((0, 1, 1, 2)):
        batch_id = min(batch, part)
        rollups.add_batch(batch_id, orders.filter(F.col("id") % 3 == part), items.filter(F.col("order_id") % 3 == part), root)
        if compact and batch == 2:
            rollups.compact(spark, root)
    return root


def rollup_dashboard(spark, d):
    return rollups.dashboard(spark, _rolled_up(spark, d, False), sales._catalog(spark, d), "visitor")


def rollup_dashboard_compacted(spark, d):
    """The same after a compaction between the batches."""
    return rollups.dashboard(spark, _rolled_up(spark, d, True), sales._catalog(spark, d), "visitor")


def _index(spark, catalog):
    path = scratch_path(spark, "search")
    # a row makes dozens of postings, and the part table is one split: dealt to all cores, as `load_spread` does
    search_index.build_index(catalog.repartition(spark.sparkContext.defaultParallelism), path)
    return search_index.read_index(spark, path, dict(catalog.dtypes)["id"])


def search_indexed(spark, d):
    catalog = sales._catalog(spark, d)
    found = search_index.search_indexed(catalog, _index(spark, catalog), " Men ", "BRAND#1", "90000", "150000")
    return C.sort_catalog(found.select("id", "name", "category", "price_minor"), "price_asc")


# searches of all kinds: mixed case, wildcards as text, shorter than a trigram, over two words, without a match
NEEDLES = ("WidGet", "%", "_", "d#", "made by", "e an", "no such text", "Brand#1", "store Sm")


def search_indexed_needles(spark, d):
    """Hits per needle; descriptions of every third product are NULL, and some names hold wildcards."""
    catalog = _searchable(spark, d)
    index = _index(spark, catalog)
    counts = [
        search_index.search_indexed(catalog, index, q=needle).agg(F.count("*").alias("hits")).select(F.lit(needle).alias("needle"), "hits")
        for needle in NEEDLES
    ]
    whole = counts[0]
    for more in counts[1:]:
        whole = whole.unionByName(more)
    return whole


def _searchable(spark, d):
    name = F.when(F.col("id") % 7 == 0, F.concat("name", F.lit(" 100%_off"))).otherwise(F.col("name"))
    text = F.when(F.col("id") % 3 > 0, F.col("description"))
    return V.parts(spark, d).withColumns({"name": name, "description": text})


SORTS = ("featured", "price_asc", "price_desc", "name")
PAGE, PAGES = 24, 3


def _listing(spark, d, *sorts):
    root = scratch_path(spark, "listing")
    listing.write_listing(sales._catalog(spark, d), root, sorts, files=16)
    return listing.Listing(spark, root)


def listing_pages(spark, d):
    """The first pages of every sort of one category and of all of them, each asked for by the cursor of the page before."""
    stored, pages = _listing(spark, d, *SORTS), []
    for sort in SORTS:
        for group in ("all", "men"):
            after = None
            for number in range(PAGES):
                page = stored.page(sort, PAGE, after, group)
                shown = (F.lit(sort).alias("sort"), F.lit(group).alias("shown"), F.lit(number).cast("bigint").alias("page"))
                pages.append(page.select(*shown, "id", "name", "price_minor"))
                last = page.tail(1)  # a page is at most PAGE rows
                if not last:
                    break
                after = last[0]["cursor"]
    return reduce(lambda a, b: a.unionByName(b), pages)


def listing_band(spark, d):
    found = _listing(spark, d, "price_asc").band(" Men ", "BRAND#1", "90000", "150000")
    return C.sort_catalog(found.select("id", "name", "category", "price_minor"), "price_asc")


def clean_catalog_csv(spark, d):
    """The published CSV of the clean catalog, read back as text."""
    root = scratch_path(spark, "published")
    names = load_table(spark, d, "part").select(F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(".webp")).alias("name"))
    clean = L.clean_catalog(raw_parts(spark, d), names)
    sinks.publish(spark, {}, root, {"catalog_csv": catalog_csv.catalog_text(clean.accepted)})
    return sinks.read_published_csv(spark, root, "catalog_csv")


QUERIES = {
    "order_readback_bucketed": order_readback_bucketed,
    "reconcile_totals_bucketed": reconcile_totals_bucketed,
    "orders_without_lines_bucketed": orders_without_lines_bucketed,
    "rollup_dashboard": rollup_dashboard,
    "rollup_dashboard_compacted": rollup_dashboard_compacted,
    "search_indexed": search_indexed,
    "search_indexed_needles": search_indexed_needles,
    "listing_pages": listing_pages,
    "listing_band": listing_band,
    "clean_catalog_csv": clean_catalog_csv,
}

_ORDERS = {
    "featured": "featured DESC NULLS LAST, lower(name), id",
    "price_asc": "price_minor ASC NULLS LAST, lower(name), id",
    "price_desc": "price_minor DESC NULLS LAST, lower(name), id",
    "name": "lower(name), id",
}
_PAGES_SQL = " UNION ALL ".join(
    f"""SELECT '{sort}' AS sort, '{group}' AS shown, (n - 1) // {PAGE} AS page, id, name, price_minor
        FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS n FROM c {where}) z WHERE n <= {PAGE * PAGES}"""
    for sort, order in _ORDERS.items()
    for group, where in (("all", ""), ("men", "WHERE category = 'men'"))
)

_LOW = "lower(coalesce({}, ''))"
_HIT = " OR ".join(
    f"contains({_LOW.format(c)}, lower(needle))" for c in ("name", "description", "brand", "source_store")
)

ORACLE = {
    "order_readback_bucketed": checkout.ORACLE["order_readback"],
    "reconcile_totals_bucketed": sales.ORACLE["reconcile_totals"],
    "orders_without_lines_bucketed": sales.ORACLE["orders_without_lines"],
    "rollup_dashboard": sales.ORACLE["analytics_bundle"],
    "rollup_dashboard_compacted": sales.ORACLE["analytics_bundle"],
    "search_indexed": sales.ORACLE["catalog_search"],
    "search_indexed_needles": V.with_views("parts", body=f"""
        , named AS (SELECT id, brand, source_store, CASE WHEN id % 7 = 0 THEN name || ' 100%_off' ELSE name END AS name,
            CASE WHEN id % 3 > 0 THEN description END AS description FROM parts),
        needles(needle) AS (VALUES {", ".join(f"('{n}')" for n in NEEDLES)})
        SELECT needle, count(id) AS hits FROM needles LEFT JOIN named ON {_HIT} GROUP BY needle"""),
    "listing_pages": V.with_views("c", body=_PAGES_SQL),
    "listing_band": sales.ORACLE["catalog_search"],
    "clean_catalog_csv": cleaning._CLEAN_SQL + """SELECT id, name, category, description, CAST(amount AS VARCHAR) AS price_minor,
        image, alt, CAST(to_json(sizes) AS VARCHAR) AS sizes, CAST(to_json(colors) AS VARCHAR) AS colors,
        CASE WHEN featured THEN '1' ELSE '0' END AS featured FROM e WHERE len(problems) = 0""",
}
