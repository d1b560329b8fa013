"""Sales, catalog and integrity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockweave.operators import analytics as A
from stockweave.operators import catalog as C
from stockweave.operators import quality as Q
from stockweave.plans import views as V
from stockweave.plans.views import with_views
from stockweave.sources.tables import load_table


def _catalog(spark, d):
    return C.active_catalog(
        V.products(spark, d), V.source_products(spark, d), V.unavailable(spark, d), V.retired(spark, d)
    )


def sales_summary(spark, d):
    return A.sales_summary(V.orders(spark, d), V.items(spark, d))


def sales_summary_visitor(spark, d):
    return A.sales_summary(V.orders(spark, d), V.items(spark, d), "visitor")


def source_counts(spark, d):
    return A.source_counts(V.orders(spark, d))


def monthly_sales(spark, d):
    return A.monthly_sales(V.orders(spark, d), V.items(spark, d))


def monthly_sales_synthetic(spark, d):
    return A.monthly_sales(V.orders(spark, d), V.items(spark, d), "synthetic")


def category_sales(spark, d):
    return A.category_sales(V.orders(spark, d), V.items(spark, d, snapshot=True))


def popular_products(spark, d):
    return A.popular_products(V.orders(spark, d), V.items(spark, d, snapshot=True), _catalog(spark, d))


def popular_products_visitor(spark, d):
    return A.popular_products(V.orders(spark, d), V.items(spark, d, snapshot=True), _catalog(spark, d), "visitor")


def month_bars(spark, d):
    bars = A.month_bars(monthly_sales(spark, d))
    return bars.select("month", F.round("bar", 6).alias("bar"))


def category_bars(spark, d):
    bars = A.category_bars(category_sales(spark, d))
    return bars.select("category", F.round("bar", 6).alias("bar"))


LISTED = ("id", "name", "category", "price_minor", "featured", "brand", "sizes", "colors")


def _listing(rows):
    """Flat columns of a product listing."""
    lists = {c: F.array_join(c, "|").alias(c) for c in ("sizes", "colors")}
    return C.product_view(rows).select(*[lists.get(c, F.col(c)) for c in LISTED], "currency")


def active_catalog(spark, d):
    return _listing(_catalog(spark, d))


def orderable_products(spark, d):
    rows = C.orderable_products(V.products(spark, d), V.unavailable(spark, d), V.retired(spark, d))
    return rows.select("id", "name", "price_minor")


def catalog_search(spark, d):
    found = C.search_catalog(_catalog(spark, d), category=" Men ", q="BRAND#1", min_price="90000", max_price="150000")
    return C.sort_catalog(found.select("id", "name", "category", "price_minor"), "price_asc")


def catalog_search_total(spark, d):
    return C.search_total(C.search_catalog(_catalog(spark, d), q="widget"))


def catalog_price_band(spark, d):
    found = C.search_catalog(_catalog(spark, d), min_price="92000", max_price="95000")
    return found.select("id", "category", "price_minor")


def _ranked(sort):
    def run(spark, d):
        listed = _catalog(spark, d).select("id", "name", "price_minor", "featured")
        return C.rank_catalog(listed, sort).select("id", "position")

    return run


def catalog_top_featured(spark, d):
    listed = _catalog(spark, d).select("id", "name", "featured")
    return C.top_k(listed, C.sort_order("featured"), 4)


# a point lookup takes an id; this one is in every size of the test tables
PRODUCT_ID = 42


def product_detail(spark, d):
    return _listing(C.get_product(_catalog(spark, d), PRODUCT_ID))


def related_to_product(spark, d):
    catalog = _catalog(spark, d).select("id", "name", "category", "featured")
    return C.related_to(catalog, PRODUCT_ID)


def related_products(spark, d):
    return C.related_products(_catalog(spark, d))


def related_products_more_categories(spark, d):
    """A catalog with categories beyond the five, and products without one."""
    catalog = _catalog(spark, d)
    kind = F.when(F.col("id") % 7 == 0, F.lit("toys")).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("category"))
    return C.related_products(catalog.withColumn("category", kind))


def analytics_bundle(spark, d):
    return A.analytics_table(V.orders(spark, d), V.items(spark, d, snapshot=True), _catalog(spark, d), "visitor")


def category_counts(spark, d):
    return Q.category_counts(_catalog(spark, d))


def provenance_split(spark, d):
    prefixed = F.when(F.col("price_minor").isNull(), F.lit("source-")).otherwise(F.lit(""))
    rows = _catalog(spark, d).select(F.concat(prefixed, F.col("id").cast("string")).alias("id"))
    return C.provenance_split(rows)


def reconcile_totals(spark, d):
    return Q.reconcile_totals(V.orders(spark, d), V.items(spark, d))


def orphans(spark, d):
    """Lines whose product cannot be ordered any more."""
    live = C.orderable_products(V.products(spark, d), V.unavailable(spark, d), V.retired(spark, d))
    lost = Q.orphans(V.items(spark, d), live, "product_id", "id")
    return lost.select("order_id", "product_id", "quantity", "unit_price_minor")


def orders_without_lines(spark, d):
    return Q.orphans(V.orders(spark, d), V.items(spark, d), "id", "order_id").select("id", "total_minor")


def uniqueness(spark, d):
    return Q.uniqueness(V.items(spark, d), "order_id")


def duplicate_lines(spark, d):
    lines = load_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return Q.unique_where_not_null(lines, ["l_orderkey", "l_linenumber"])


def duplicate_source_identity(spark, d):
    listed = _catalog(spark, d).select("source_store", "name")
    return Q.unique_where_not_null(listed, ["source_store", "name"])


def constraint_violations(spark, d):
    rows = V.items(spark, d, snapshot=True).withColumn("line_no", F.lit(1))
    return (
        Q.check_constraints(rows, ["order_id", "product_id"], Q.order_item_rules())
        .groupBy("order_id", "rule")
        .agg(F.count("*").alias("lines"))
    )


def catalog_violations(spark, d):
    rules = Q.product_rules(lists_as_json=True)
    return Q.check_constraints(_catalog(spark, d), ["id"], rules)


def distinct_months(spark, d):
    return Q.distinct_values(V.orders(spark, d), A.month_of(), "month")


def distinct_sources(spark, d):
    return Q.distinct_values(V.orders(spark, d), F.col("source"), "source")


QUERIES = {
    "sales_summary": sales_summary,
    "sales_summary_visitor": sales_summary_visitor,
    "source_counts": source_counts,
    "monthly_sales": monthly_sales,
    "monthly_sales_synthetic": monthly_sales_synthetic,
    "category_sales": category_sales,
    "popular_products": popular_products,
    "popular_products_visitor": popular_products_visitor,
    "month_bars": month_bars,
    "category_bars": category_bars,
    "active_catalog": active_catalog,
    "orderable_products": orderable_products,
    "catalog_search": catalog_search,
    "catalog_search_total": catalog_search_total,
    "catalog_price_band": catalog_price_band,
    "catalog_sorted_featured": _ranked("featured"),
    "catalog_sorted_price_asc": _ranked("price_asc"),
    "catalog_sorted_price_desc": _ranked("price_desc"),
    "catalog_sorted_name": _ranked("name"),
    "catalog_top_featured": catalog_top_featured,
    "product_detail": product_detail,
    "related_to_product": related_to_product,
    "related_products": related_products,
    "related_products_more_categories": related_products_more_categories,
    "analytics_bundle": analytics_bundle,
    "category_counts": category_counts,
    "provenance_split": provenance_split,
    "reconcile_totals": reconcile_totals,
    "orphans": orphans,
    "orders_without_lines": orders_without_lines,
    "uniqueness": uniqueness,
    "duplicate_lines": duplicate_lines,
    "duplicate_source_identity": duplicate_source_identity,
    "constraint_violations": constraint_violations,
    "catalog_violations": catalog_violations,
    "distinct_months": distinct_months,
    "distinct_sources": distinct_sources,
}


def _summary_sql(where: str = "") -> str:
    return with_views("o", "i", body=f"""
        SELECT count(*) AS orders, CAST(coalesce(sum(total_minor), 0) AS BIGINT) AS revenue_minor,
            coalesce(CAST(round(avg(total_minor)) AS BIGINT), 0) AS average_order_minor,
            (SELECT CAST(coalesce(sum(i.quantity), 0) AS BIGINT) FROM i JOIN o ON o.id = i.order_id {where}) AS units
        FROM o {where}""")


def _monthly_sql(where: str = "") -> str:
    return with_views("o", "i", body=f"""
        SELECT strftime(o.created_at, '%Y-%m') AS month, count(DISTINCT o.id) AS orders,
            CAST(sum(i.unit_price_minor * i.quantity) AS BIGINT) AS revenue_minor,
            CAST(sum(i.quantity) AS BIGINT) AS units
        FROM o JOIN i ON i.order_id = o.id {where} GROUP BY 1""")


_CATEGORY_SQL = """SELECT category, CAST(sum(quantity) AS BIGINT) AS units,
    CAST(sum(unit_price_minor * quantity) AS BIGINT) AS revenue_minor
    FROM isnap JOIN o ON o.id = isnap.order_id GROUP BY category"""


def _popular_sql(where: str = "") -> str:
    return with_views("o", "isnap", "c", body=f"""
        SELECT product_id, max(product_name) AS name, max(category) AS category,
            CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(unit_price_minor * quantity) AS BIGINT) AS revenue_minor,
            product_id IN (SELECT id FROM c) AS active
        FROM isnap JOIN o ON o.id = isnap.order_id {where}
        GROUP BY product_id ORDER BY units DESC, revenue_minor DESC, product_id LIMIT 5""")


def _ranked_sql(order: str) -> str:
    return with_views("c", body=f"SELECT id, row_number() OVER (ORDER BY {order}) AS position FROM c")


def _related_sql(category: str) -> str:
    return with_views("c", body=f"""
        , k AS (SELECT id, name, kind AS category,
            row_number() OVER (PARTITION BY kind ORDER BY featured DESC, lower(name), id) AS n
            FROM (SELECT *, {category} AS kind FROM c))
        SELECT a.id, a.category, row_number() OVER (PARTITION BY a.id ORDER BY b.n) AS position,
            b.id AS related_id, b.name AS related_name
        FROM k a JOIN k b ON b.category = a.category AND b.id <> a.id AND b.n <= 5
        QUALIFY position <= 4""")


_LISTING_SQL = "SELECT id, name, category, price_minor, featured, brand, sizes, colors, 'INR' AS currency FROM c"

ORACLE = {
    "sales_summary": _summary_sql(),
    "sales_summary_visitor": _summary_sql("WHERE o.source = 'visitor'"),
    "source_counts": with_views("o", body="SELECT source, count(*) AS orders FROM o GROUP BY source"),
    "monthly_sales": _monthly_sql(),
    "monthly_sales_synthetic": _monthly_sql("WHERE o.source = 'synthetic'"),
    "category_sales": with_views("o", "isnap", body=_CATEGORY_SQL),
    "popular_products": _popular_sql(),
    "popular_products_visitor": _popular_sql("WHERE o.source = 'visitor'"),
    "month_bars": with_views("o", "i", body="""
        , m AS (SELECT strftime(o.created_at, '%Y-%m') AS month, sum(i.unit_price_minor * i.quantity) AS revenue_minor
            FROM o JOIN i ON i.order_id = o.id GROUP BY 1)
        SELECT month, round(greatest(1, revenue_minor::DOUBLE
            / (SELECT greatest(1, max(revenue_minor)) FROM m)::DOUBLE * 155), 6) AS bar FROM m"""),
    "category_bars": with_views("o", "isnap", body=f"""
        , m AS ({_CATEGORY_SQL})
        SELECT category, round(revenue_minor::DOUBLE
            / (SELECT greatest(1, max(revenue_minor)) FROM m)::DOUBLE * 100, 6) AS bar FROM m"""),
    "active_catalog": with_views("c", body=_LISTING_SQL),
    "orderable_products": with_views("p", "u", "r", body="""
        SELECT id, name, price_minor FROM p
        WHERE id NOT IN (SELECT id FROM u) AND id NOT IN (SELECT product_id FROM r)"""),
    "catalog_search": with_views("c", body="""
        SELECT id, name, category, price_minor FROM c
        WHERE category = 'men' AND price_minor >= 90000 AND price_minor <= 150000
            AND (name ILIKE '%brand#1%' OR description ILIKE '%brand#1%' OR brand ILIKE '%brand#1%'
                OR source_store ILIKE '%brand#1%')"""),
    "catalog_search_total": with_views("c", body="""
        SELECT count(*) AS total FROM c WHERE name ILIKE '%widget%' OR description ILIKE '%widget%'
            OR brand ILIKE '%widget%' OR source_store ILIKE '%widget%'"""),
    "catalog_price_band": with_views("c", body="""
        SELECT id, category, price_minor FROM c WHERE price_minor BETWEEN 92000 AND 95000"""),
    "catalog_sorted_featured": _ranked_sql("featured DESC, lower(name), id"),
    "catalog_sorted_price_asc": _ranked_sql("price_minor ASC NULLS LAST, lower(name), id"),
    "catalog_sorted_price_desc": _ranked_sql("price_minor DESC NULLS LAST, lower(name), id"),
    "catalog_sorted_name": _ranked_sql("lower(name), id"),
    "catalog_top_featured": with_views("c", body="""
        SELECT id, name, featured FROM c ORDER BY featured DESC, lower(name), id LIMIT 4"""),
    "product_detail": with_views("c", body=_LISTING_SQL + f" WHERE id = {PRODUCT_ID}"),
    "related_to_product": with_views("c", body=f"""
        SELECT id, name, category, featured FROM c
        WHERE category = (SELECT category FROM c WHERE id = {PRODUCT_ID}) AND id <> {PRODUCT_ID}
        ORDER BY featured DESC, lower(name), id LIMIT 4"""),
    "related_products": _related_sql("category"),
    "related_products_more_categories": _related_sql(
        "CASE WHEN id % 7 = 0 THEN 'toys' WHEN id % 11 = 0 THEN NULL ELSE category END"
    ),
    "analytics_bundle": with_views("o", "isnap", "c", body="""
        , vo AS (SELECT * FROM o WHERE source = 'visitor'),
        sv AS (SELECT isnap.*, strftime(vo.created_at, '%Y-%m') AS month, quantity * unit_price_minor AS value
            FROM isnap JOIN vo ON vo.id = isnap.order_id),
        best AS (SELECT product_id, sum(quantity) AS units, sum(value) AS value FROM sv GROUP BY 1
            ORDER BY 2 DESC, 3 DESC, 1 LIMIT 5),
        bundle AS (
            SELECT 'summary' AS part, 'all' AS entry, count(*) AS orders, (SELECT coalesce(sum(quantity), 0) FROM sv) AS units,
                coalesce(sum(total_minor), 0) AS revenue_minor, coalesce(round(avg(total_minor)), 0) AS average_order_minor,
                NULL::BOOLEAN AS active FROM vo
            UNION ALL SELECT 'source_counts', k.source, count(o.id), NULL, NULL, NULL, NULL
                FROM (VALUES ('synthetic'), ('visitor')) k(source) LEFT JOIN o ON o.source = k.source GROUP BY k.source
            UNION ALL SELECT 'monthly', month, count(DISTINCT order_id), sum(quantity), sum(value), NULL, NULL FROM sv GROUP BY month
            UNION ALL SELECT 'categories', category, NULL, sum(quantity), sum(value), NULL, NULL FROM sv GROUP BY category
            UNION ALL SELECT 'popular', CAST(product_id AS VARCHAR), NULL, units, value, NULL,
                product_id IN (SELECT id FROM c) FROM best)
        SELECT part, entry, CAST(orders AS BIGINT) AS orders, CAST(units AS BIGINT) AS units,
            CAST(revenue_minor AS BIGINT) AS revenue_minor, CAST(average_order_minor AS BIGINT) AS average_order_minor,
            active, 'visitor' AS source, 'INR' AS currency FROM bundle"""),
    "category_counts": with_views("c", body="SELECT category, count(*) AS products FROM c GROUP BY category"),
    "provenance_split": with_views("c", body="""
        SELECT CASE WHEN price_minor IS NULL THEN 'imported' ELSE 'curated' END AS origin, count(*) AS products
        FROM c GROUP BY 1"""),
    "reconcile_totals": with_views("o", "i", body="""
        SELECT o.id AS order_id, o.total_minor,
            CAST(sum(i.unit_price_minor * i.quantity) AS BIGINT) AS lines_minor
        FROM o JOIN i ON i.order_id = o.id GROUP BY o.id, o.total_minor
        HAVING o.total_minor <> sum(i.unit_price_minor * i.quantity)"""),
    "orphans": with_views("i", "p", "u", "r", body="""
        SELECT order_id, product_id, quantity, unit_price_minor FROM i WHERE product_id NOT IN (
            SELECT id FROM p WHERE id NOT IN (SELECT id FROM u) AND id NOT IN (SELECT product_id FROM r))"""),
    "orders_without_lines": with_views("o", "i", body="""
        SELECT id, total_minor FROM o WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.order_id = o.id)"""),
    "uniqueness": with_views("i", body="""
        SELECT count(*) AS total_rows, count(DISTINCT order_id) AS distinct_keys FROM i"""),
    "duplicate_lines": """SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "duplicate_source_identity": with_views("c", body="""
        SELECT source_store, name, count(*) AS occurrences FROM c
        WHERE source_store IS NOT NULL AND name IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1"""),
    "constraint_violations": with_views("i", body="""
        SELECT order_id, 'quantity_range' AS rule, count(*) AS lines FROM i
        WHERE quantity NOT BETWEEN 1 AND 10 GROUP BY order_id"""),
    "catalog_violations": with_views("c", body="""
        SELECT id, 'price_minor_required' AS rule FROM c WHERE price_minor IS NULL"""),
    "distinct_months": with_views("o", body="SELECT DISTINCT strftime(created_at, '%Y-%m') AS month FROM o"),
    "distinct_sources": with_views("o", body="SELECT DISTINCT source FROM o"),
}
