"""The shared test tables seen as catalog, order and feed tables.

`sql_views()` states the same mappings as common table expressions, so that the
comparison queries start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.functions.money import rupees_to_paise
from stockweave.sources.tables import load_table

# p_type to the five catalog categories
CATEGORY_OF_TYPE = {"STANDARD": "men", "PROMO": "women", "SMALL": "kids", "ECONOMY": "accessories"}
# brands whose parts play the unpriced source-only listings
SOURCE_BRANDS = ("Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5")


def category():
    chain = F.lit("footwear")
    for kind, name in CATEGORY_OF_TYPE.items():
        chain = F.when(F.col("p_type") == kind, F.lit(name)).otherwise(chain)
    return chain


def orders(spark: SparkSession, d: str) -> DataFrame:
    return load_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", F.lit("synthetic")).otherwise(F.lit("visitor")).alias("source"),
        rupees_to_paise("o_totalprice").alias("total_minor"),
        F.col("o_orderdate").alias("created_at"),
    )


def items(spark: SparkSession, d: str, snapshot: bool = False) -> DataFrame:
    """Order lines; with `snapshot` also the product name and category they carry."""
    lines = load_table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.round(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("bigint").alias("unit_price_minor"),
    )
    if not snapshot:
        return lines
    names = load_table(spark, d, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), category().alias("category")
    )
    return lines.join(names, "product_id")


def parts(spark: SparkSession, d: str) -> DataFrame:
    """Every part as a priced product with the 24 catalog columns; lists as JSON text."""
    none = F.lit(None)
    first_word = F.substring_index("p_name", " ", 1)
    return load_table(spark, d, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        category().alias("category"),
        F.concat(F.lit("An everyday "), "p_name", F.lit(" made by "), "p_brand").alias("description"),
        rupees_to_paise("p_retailprice").alias("price_minor"),
        F.concat(F.lit("/assets/images/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(".webp")).alias("image"),
        F.concat("p_name", F.lit(" product image")).alias("alt"),
        F.when(F.col("p_size") % 4 == 0, F.lit("[]")).otherwise(F.lit('["S","M","L"]')).alias("sizes"),
        F.concat(F.lit('["'), first_word, F.lit('"]')).alias("colors"),
        (F.col("p_size") % 5 == 0).alias("featured"),
        F.col("p_brand").alias("brand"),
        F.lower("p_type").alias("subcategory"),
        none.cast("bigint").alias("mrp_minor"),
        none.cast("int").alias("discount_percent"),
        none.cast("string").alias("material"),
        none.cast("string").alias("fit"),
        none.cast("double").alias("rating_value"),
        none.cast("double").alias("rating_scale"),
        none.cast("bigint").alias("rating_count"),
        F.concat(F.lit("Store "), "p_type").alias("source_store"),
        F.col("p_partkey").cast("string").alias("source_product_id"),
        F.concat(F.lit("https://shop.example/p/"), F.col("p_partkey").cast("string")).alias("canonical_url"),
        F.lit("existing").alias("verification_status"),
        F.lit("[]").alias("missing_fields"),
    )


def products(spark: SparkSession, d: str) -> DataFrame:
    return parts(spark, d).filter(~F.col("brand").isin(*SOURCE_BRANDS))


def source_products(spark: SparkSession, d: str) -> DataFrame:
    rows = parts(spark, d).filter(F.col("brand").isin(*SOURCE_BRANDS))
    return rows.withColumn("price_minor", F.lit(None).cast("bigint"))


def unavailable(spark: SparkSession, d: str) -> DataFrame:
    small = load_table(spark, d, "part").filter("p_size <= 5")
    return small.select(F.col("p_partkey").alias("id"), F.lit("price not verified").alias("reason"))


def retired(spark: SparkSession, d: str) -> DataFrame:
    large = load_table(spark, d, "part").filter("p_size >= 46")
    return large.select(F.col("p_partkey").alias("product_id"))


SQL_VIEWS = {
    "o": """SELECT o_orderkey AS id,
        CASE WHEN o_orderstatus = 'F' THEN 'synthetic' ELSE 'visitor' END AS source,
        CAST(round(o_totalprice * 100) AS BIGINT) AS total_minor, o_orderdate AS created_at FROM orders""",
    "i": """SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
        CAST(round(l_extendedprice * 100 / l_quantity) AS BIGINT) AS unit_price_minor FROM lineitem""",
    "parts": """SELECT p_partkey AS id, p_name AS name,
        CASE p_type WHEN 'STANDARD' THEN 'men' WHEN 'PROMO' THEN 'women' WHEN 'SMALL' THEN 'kids'
            WHEN 'ECONOMY' THEN 'accessories' ELSE 'footwear' END AS category,
        'An everyday ' || p_name || ' made by ' || p_brand AS description,
        CAST(round(p_retailprice * 100) AS BIGINT) AS price_minor,
        '/assets/images/' || replace(p_name, ' ', '-') || '.webp' AS image,
        p_name || ' product image' AS alt,
        CASE WHEN p_size % 4 = 0 THEN '' ELSE 'S|M|L' END AS sizes,
        split_part(p_name, ' ', 1) AS colors,
        p_size % 5 = 0 AS featured, p_brand AS brand, 'Store ' || p_type AS source_store,
        CAST(p_partkey AS VARCHAR) AS source_product_id,
        'https://shop.example/p/' || CAST(p_partkey AS VARCHAR) AS canonical_url,
        p_size FROM part""",
    "isnap": "SELECT i.*, parts.name AS product_name, parts.category FROM i JOIN parts ON parts.id = i.product_id",
    "p": "SELECT * FROM parts WHERE brand NOT IN ('Brand#1','Brand#2','Brand#3','Brand#4','Brand#5')",
    "s": """SELECT * REPLACE (CAST(NULL AS BIGINT) AS price_minor) FROM parts
        WHERE brand IN ('Brand#1','Brand#2','Brand#3','Brand#4','Brand#5')""",
    "u": "SELECT p_partkey AS id FROM part WHERE p_size <= 5",
    "r": "SELECT p_partkey AS product_id FROM part WHERE p_size >= 46",
    "c": """SELECT p.* REPLACE (CASE WHEN u.id IS NOT NULL THEN NULL ELSE p.price_minor END AS price_minor)
        FROM p LEFT JOIN u ON u.id = p.id LEFT JOIN r ON r.product_id = p.id WHERE r.product_id IS NULL
        UNION ALL SELECT s.* FROM s LEFT JOIN r ON r.product_id = s.id WHERE r.product_id IS NULL""",
}
NEEDS = {"isnap": ("i", "parts"), "p": ("parts",), "s": ("parts",), "c": ("parts", "p", "s", "u", "r")}


def with_views(*names: str, body: str) -> str:
    """`body` after the common table expressions it names."""
    wanted: list[str] = []
    for name in names:
        for needed in (*NEEDS.get(name, ()), name):
            if needed not in wanted:
                wanted.append(needed)
    return "WITH " + ", ".join(f"{n} AS ({SQL_VIEWS[n]})" for n in wanted) + " " + body
