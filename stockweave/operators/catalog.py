"""Active catalog: search, filters, sorts, lookups and related products."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stockweave.functions.text import ascii_lower, contains_literal
from stockweave.operators.errors import RequestError
from stockweave.operators.ranking import rank_rows
from stockweave.schemas import CATEGORIES, PRODUCT_COLUMNS

MAX_SEARCH = 100
SEARCHED = ("name", "description", "brand", "source_store")
LISTS = ("sizes", "colors", "missing_fields")


def product_view(products: DataFrame) -> DataFrame:
    """Catalog columns in order: lists decoded, flag as boolean, currency added."""
    kinds = dict(zip(products.columns, (f.dataType for f in products.schema.fields)))

    def shown(name: str) -> Column:
        if name in LISTS and isinstance(kinds[name], StringType):
            return F.from_json(name, "array<string>").alias(name)
        if name == "featured":
            return F.col(name).cast("boolean").alias(name)
        return F.col(name)

    return products.select(*[shown(c) for c in PRODUCT_COLUMNS if c in kinds], F.lit("INR").alias("currency"))


def active_catalog(
    products: DataFrame, source_products: DataFrame, unavailable: DataFrame, retired: DataFrame
) -> DataFrame:
    """Curated and source rows that are not retired; unavailable products lose their price.

    The price filter of a search cannot move below the mask, everything else can.
    """
    gone = retired.select(F.col("product_id").alias("id"))
    hidden = unavailable.select("id", F.lit(True).alias("_hidden"))
    columns = products.columns
    price = F.when(F.col("_hidden").isNull(), F.col("price_minor")).alias("price_minor")
    curated = (
        products.join(gone, "id", "left_anti")
        .join(hidden, "id", "left")
        .select(*[price if c == "price_minor" else F.col(c) for c in columns])
    )
    return curated.unionByName(source_products.join(gone, "id", "left_anti").select(*columns))


def orderable_products(products: DataFrame, unavailable: DataFrame, retired: DataFrame) -> DataFrame:
    gone = retired.select(F.col("product_id").alias("id"))
    return products.join(unavailable.select("id"), "id", "left_anti").join(gone, "id", "left_anti")


def _paise(value, name: str) -> int | None:
    if value is None or value == "":
        return None
    text = str(value)
    if not re.fullmatch(r"[0-9]{1,9}", text):
        raise RequestError(f"{name} must be a non-negative integer in paise.")
    return int(text)


def search_catalog(catalog: DataFrame, category: str = "", q: str = "", min_price=None, max_price=None) -> DataFrame:
    """Filter by category, literal text and an inclusive price range; blanks do not filter."""
    wanted = (category or "").strip().lower()
    if wanted and wanted != "all":
        if wanted not in CATEGORIES:
            raise RequestError("Choose a valid product category.")
        catalog = catalog.filter(F.col("category") == wanted)
    needle = (q or "").strip()
    if len(needle) > MAX_SEARCH:
        raise RequestError(f"Search must be {MAX_SEARCH} characters or fewer.")
    if needle:
        hit = F.lit(False)
        for name in SEARCHED:
            if name in catalog.columns:
                hit = hit | contains_literal(name, needle)
        catalog = catalog.filter(hit)
    low, high = _paise(min_price, "min_price"), _paise(max_price, "max_price")
    if low is not None and high is not None and low > high:
        raise RequestError("Minimum price cannot exceed maximum price.")
    if low is not None:
        catalog = catalog.filter(F.col("price_minor") >= low)
    if high is not None:
        catalog = catalog.filter(F.col("price_minor") <= high)
    return catalog


def _by_name() -> list[Column]:
    return [ascii_lower("name").asc(), F.col("id").asc()]


def sort_order(sort: str = "featured") -> list[Column]:
    """Total orders: each ends with the id, so equal names or prices still spread out."""
    orders = {
        "featured": [F.col("featured").desc(), *_by_name()],
        "price_asc": [F.col("price_minor").asc_nulls_last(), *_by_name()],
        "price_desc": [F.col("price_minor").desc_nulls_last(), *_by_name()],
        "name": _by_name(),
    }
    if sort not in orders:
        raise RequestError("Choose a valid product sort order.")
    return orders[sort]


def sort_catalog(catalog: DataFrame, sort: str = "featured") -> DataFrame:
    return catalog.orderBy(*sort_order(sort))


def rank_catalog(catalog: DataFrame, sort: str = "featured") -> DataFrame:
    """The sorted listing with its position as a column."""
    return rank_rows(catalog, sort_order(sort), "position")


def search_total(catalog: DataFrame) -> DataFrame:
    return catalog.agg(F.count("*").alias("total"))


def top_k(rows: DataFrame, order: list[Column], k: int) -> DataFrame:
    return rows.orderBy(*order).limit(k)


def get_product(catalog: DataFrame, product_id) -> DataFrame:
    """Zero rows mean the product could not be found."""
    return catalog.filter(F.col("id") == F.lit(product_id))


def related_to(catalog: DataFrame, product_id, k: int = 4) -> DataFrame:
    """Top `k` of the category of one product, without the product itself."""
    own = get_product(catalog, product_id).select(F.max("category")).scalar()
    others = catalog.filter((F.col("category") == own) & (F.col("id") != F.lit(product_id)))
    return top_k(others, sort_order("featured"), k)


def related_products(catalog: DataFrame, k: int = 4) -> DataFrame:
    """Top `k` others of its category for every product of any category.

    Self-exclusion removes one row at most, so the first k+1 of a category
    answer all its products. The window filter is a group limit: each map task
    sends k+1 rows per category, however large the category is.
    """
    within = Window.partitionBy("category").orderBy(*sort_order("featured"))
    top = catalog.withColumn("_n", F.row_number().over(within)).filter(F.col("_n") <= k + 1)
    heads = top.groupBy("category").agg(
        F.array_sort(F.collect_list(F.struct("_n", "id", "name"))).alias("_heads")
    )
    # a row of k+1 entries per category, on the right side: a hot category is split on the left
    paired = catalog.select("id", "category").join(heads, "category")
    others = F.slice(F.filter("_heads", lambda h: h["id"] != F.col("id")), 1, k)
    return paired.select("id", "category", F.posexplode(others).alias("_at", "_other")).select(
        "id",
        "category",
        (F.col("_at") + 1).cast("bigint").alias("position"),
        F.col("_other.id").alias("related_id"),
        F.col("_other.name").alias("related_name"),
    )


def provenance_split(products: DataFrame, prefix: str = "source-") -> DataFrame:
    """Rows per origin, told by the id prefix."""
    origin = F.when(F.col("id").startswith(prefix), F.lit("imported")).otherwise(F.lit("curated"))
    return products.groupBy(origin.alias("origin")).agg(F.count("*").alias("products"))
