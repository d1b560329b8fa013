"""Sales summaries over order headers and order lines.

Headers are unique by id, lines are not; a hot order only ever skews the line
side of a header join, which AQE splits. Money is summed as whole paise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.operators.errors import RequestError
from stockweave.schemas import ORDER_SOURCES
from stockweave.session import settle_table

POPULAR = 5


def source_filter(orders: DataFrame, source: str = "all") -> DataFrame:
    if source == "all":
        return orders
    if source not in ORDER_SOURCES:
        raise RequestError("Analytics source must be all, synthetic or visitor.")
    return orders.filter(F.col("source") == source)


def _value() -> Column:
    return F.col("unit_price_minor") * F.col("quantity")


def _total(amount, name: str) -> Column:
    return F.coalesce(F.sum(amount), F.lit(0)).cast("bigint").alias(name)


def _sold(orders: DataFrame, items: DataFrame, source: str, *columns: str) -> DataFrame:
    """Lines of the selected orders; only the wanted columns travel through the join."""
    wanted = source_filter(orders, source).select(F.col("id").alias("order_id"))
    return items.select("order_id", *columns).join(wanted, "order_id", "left_semi")


def units_sold(orders: DataFrame, items: DataFrame, source: str = "all") -> DataFrame:
    # one row per order before the join: a hot order is summed map-side
    per_order = items.groupBy("order_id").agg(F.sum("quantity").alias("units"))
    return _sold(orders, per_order, source, "units").agg(_total("units", "units"))


def sales_summary(orders: DataFrame, items: DataFrame, source: str = "all") -> DataFrame:
    """Orders, revenue and average from the headers; units from the lines."""
    mean = F.coalesce(F.round(F.avg("total_minor")).cast("bigint"), F.lit(0))
    headline = source_filter(orders, source).agg(
        F.count("*").alias("orders"),
        _total("total_minor", "revenue_minor"),
        mean.alias("average_order_minor"),
    )
    return headline.select("*", units_sold(orders, items, source).scalar().alias("units"))


def source_counts(orders: DataFrame) -> DataFrame:
    """Orders per source, zero where a source has none; never filtered."""
    spark = orders.sparkSession
    known = spark.range(1).select(
        F.explode(F.array(*[F.lit(s) for s in ORDER_SOURCES])).alias("source"), F.lit(0).cast("bigint").alias("n")
    )
    found = orders.select("source", F.lit(1).cast("bigint").alias("n"))
    return found.unionByName(known).groupBy("source").agg(_total("n", "orders"))


def month_of(c="created_at") -> Column:
    return F.substring(F.col(c).cast("string"), 1, 7)


def order_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.sum(_value()).alias("revenue_minor"), F.sum("quantity").alias("units"))


def monthly_sales(orders: DataFrame, items: DataFrame, source: str = "all") -> DataFrame:
    """Months that have lines; summing per order first makes the distinct count a plain one."""
    headers = source_filter(orders, source).select(F.col("id").alias("order_id"), month_of().alias("month"))
    return (
        order_totals(items)
        .join(headers, "order_id")
        .groupBy("month")
        .agg(F.count("*").alias("orders"), _total("revenue_minor", "revenue_minor"), _total("units", "units"))
        .orderBy("month")
    )


def category_sales(orders: DataFrame, items: DataFrame, source: str = "all") -> DataFrame:
    return (
        _sold(orders, items, source, "category", "unit_price_minor", "quantity")
        .groupBy("category")
        .agg(_total("quantity", "units"), _total(_value(), "revenue_minor"))
        .orderBy(F.desc("revenue_minor"), "category")
    )


def with_active_flag(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """Is the product still listed? Only the catalog's ids that `rows` asks for are made distinct."""
    wanted = rows.select(F.col("product_id").alias("id"))
    listed = catalog.select("id").join(wanted, "id", "left_semi").distinct()
    flags = listed.select(F.col("id").alias("product_id"), F.lit(True).alias("_listed"))
    return rows.join(flags, "product_id", "left").select(
        *rows.columns, F.coalesce("_listed", F.lit(False)).alias("active")
    )


def popular_products(
    orders: DataFrame, items: DataFrame, catalog: DataFrame, source: str = "all", k: int = POPULAR
) -> DataFrame:
    """Top `k` by units, revenue, id; one lazy plan. The catalog is only asked about those k ids."""
    order = [F.desc("units"), F.desc("revenue_minor"), F.col("product_id")]
    best = (
        _sold(orders, items, source, "product_id", "product_name", "category", "unit_price_minor", "quantity")
        .groupBy("product_id")
        .agg(
            F.max("product_name").alias("name"),
            F.max("category").alias("category"),
            _total("quantity", "units"),
            _total(_value(), "revenue_minor"),
        )
        .orderBy(*order)
        .limit(k)
    )
    return with_active_flag(best, catalog).orderBy(*order)


def bar_scale(rows: DataFrame, value: str, size: float, floor: float = 0.0, name: str = "bar") -> DataFrame:
    """Share of the largest value, scaled to `size`; the maximum is a scalar subquery."""
    largest = rows.agg(F.greatest(F.lit(1), F.coalesce(F.max(value), F.lit(1)))).scalar()
    return rows.withColumn(name, F.greatest(F.lit(float(floor)), F.col(value) / largest * F.lit(float(size))))


def month_bars(monthly: DataFrame) -> DataFrame:
    return bar_scale(monthly, "revenue_minor", 155, 1)


def category_bars(categories: DataFrame) -> DataFrame:
    return bar_scale(categories, "revenue_minor", 100)


def analytics(orders: DataFrame, items: DataFrame, catalog: DataFrame, source: str = "all") -> dict[str, DataFrame]:
    """The dashboard bundle, each part lazy; lines meet their headers once.

    Lines are summed per order, product and category first; these sums, with the month of their
    order, are written once, and units, months, categories and products derive from them.
    """
    headers = source_filter(orders, source).select(F.col("id").alias("order_id"), month_of().alias("month"))
    per_line = items.groupBy("order_id", "product_id", "category").agg(
        F.max("product_name").alias("name"), F.sum("quantity").alias("units"), F.sum(_value()).alias("revenue_minor")
    )
    sold = settle_table(per_line.join(headers, "order_id"), "sold")
    sums = [_total("units", "units"), _total("revenue_minor", "revenue_minor")]
    headline = source_filter(orders, source).agg(
        F.count("*").alias("orders"),
        _total("total_minor", "revenue_minor"),
        F.coalesce(F.round(F.avg("total_minor")).cast("bigint"), F.lit(0)).alias("average_order_minor"),
    )
    per_order = sold.groupBy("order_id", "month").agg(*sums)
    order = [F.desc("units"), F.desc("revenue_minor"), F.col("product_id")]
    best = sold.groupBy("product_id").agg(F.max("name").alias("name"), F.max("category").alias("category"), *sums)
    return {
        "summary": headline.select("*", sold.agg(_total("units", "units")).scalar().alias("units")),
        "source_counts": source_counts(orders),
        "monthly": per_order.groupBy("month").agg(F.count("*").alias("orders"), *sums).orderBy("month"),
        "categories": sold.groupBy("category").agg(*sums).orderBy(F.desc("revenue_minor"), "category"),
        "popular": with_active_flag(best.orderBy(*order).limit(POPULAR), catalog).orderBy(*order),
    }


def analytics_table(
    orders: DataFrame, items: DataFrame, catalog: DataFrame, source: str = "all", currency: str = "INR"
) -> DataFrame:
    """The bundle as one flat table: part, entry, its figures (NULL where a part has none), source and currency."""
    parts = analytics(orders, items, catalog, source)
    entry = {"summary": F.lit("all"), "source_counts": F.col("source"), "monthly": F.col("month"),
             "categories": F.col("category"), "popular": F.col("product_id").cast("string")}
    figures = ("orders", "units", "revenue_minor", "average_order_minor")
    rows = [
        table.select(
            F.lit(name).alias("part"),
            entry[name].alias("entry"),
            *[(F.col(f) if f in table.columns else F.lit(None)).cast("bigint").alias(f) for f in figures],
            (F.col("active") if "active" in table.columns else F.lit(None)).cast("boolean").alias("active"),
        )
        for name, table in parts.items()
    ]
    whole = reduce(DataFrame.unionByName, rows)
    return whole.select("*", F.lit(source).alias("source"), F.lit(currency).alias("currency"))
