"""Integrity checks over tables that have no enforced constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.functions.text import present
from stockweave.schemas import CATEGORIES, MAX_QUANTITY, ORDER_SOURCES

MAX_PRICE_MINOR = 100_000_000


def check_constraints(rows: DataFrame, key: list[str], rules: dict[str, Column]) -> DataFrame:
    """One row per broken rule. Like a CHECK, a rule that is NULL is not broken."""
    broken = present(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()])
    return rows.select(*key, F.explode(broken).alias("rule"))


def _whole(name: str) -> Column:
    return F.col(name) == F.floor(name)


def _required(*names: str) -> dict[str, Column]:
    return {f"{name}_required": F.col(name).isNotNull() for name in names}


def _json_list(name: str) -> Column:
    """TRUE for text that holds a JSON array."""
    return F.coalesce(F.json_array_length(name) >= 0, F.lit(False)) | F.col(name).isNull()


def product_rules(unpriced: bool = False, lists_as_json: bool = False) -> dict[str, Column]:
    """Rules of the product table; source-only listings must not carry a price."""
    rules = {
        **_required("name", "category", "image", "alt", "sizes", "colors", "featured"),
        "name_length": F.length("name").between(1, 120),
        "featured_flag": F.col("featured").cast("int").isin(0, 1),
        "category_known": F.col("category").isin(*CATEGORIES),
        "mrp_positive": (F.col("mrp_minor") > 0) & _whole("mrp_minor"),
        "discount_range": F.col("discount_percent").between(0, 100),
        "rating_value_range": F.col("rating_value") >= 0,
        "rating_scale_range": F.col("rating_scale") > 0,
        "rating_count_range": F.col("rating_count") >= 0,
    }
    if unpriced:
        rules |= {
            **_required("source_store", "canonical_url", "verification_status", "missing_fields"),
            "price_absent": F.col("price_minor").isNull(),
        }
    else:
        rules |= {
            **_required("description", "price_minor"),
            "price_range": (F.col("price_minor") > 0) & (F.col("price_minor") <= MAX_PRICE_MINOR),
            "price_whole": _whole("price_minor"),
        }
    if lists_as_json:
        rules |= {f"{name}_is_list": _json_list(name) for name in ("sizes", "colors", "missing_fields")}
    return rules


def unavailable_rules() -> dict[str, Column]:
    return _required("id", "reason")


def retired_rules() -> dict[str, Column]:
    return _required("product_id", "name", "failure_reason", "retired_at")


def order_rules() -> dict[str, Column]:
    return {
        **_required("id", "idempotency_key", "request_hash", "source", "total_minor", "created_at"),
        "source_known": F.col("source").isin(*ORDER_SOURCES),
        "total_range": (F.col("total_minor") >= 0) & _whole("total_minor"),
    }


def order_item_rules() -> dict[str, Column]:
    return {
        **_required("order_id", "line_no", "product_id", "product_name", "category", "unit_price_minor", "quantity"),
        "line_no_range": F.col("line_no") >= 1,
        "category_known": F.col("category").isin(*CATEGORIES),
        "unit_price_range": F.col("unit_price_minor") > 0,
        "unit_price_whole": _whole("unit_price_minor"),
        "quantity_range": F.col("quantity").between(1, MAX_QUANTITY),
        "quantity_whole": _whole("quantity"),
    }


def unique_where_not_null(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once among rows where every key column is set."""
    filled = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return rows.filter(filled).groupBy(*keys).agg(F.count("*").alias("occurrences")).filter("occurrences > 1")


def uniqueness(rows: DataFrame, key: str) -> DataFrame:
    return rows.agg(F.count("*").alias("total_rows"), F.countDistinct(key).alias("distinct_keys"))


def distinct_values(rows: DataFrame, expression: Column, name: str) -> DataFrame:
    return rows.select(expression.alias(name)).distinct().orderBy(name)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose parent does not exist; a NULL reference is allowed."""
    keys = parent.select(F.col(parent_key).alias("_parent")).distinct()
    return child.filter(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("_parent"), "left_anti")


def reconcile_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Headers whose total is not the sum of their lines."""
    lines = items.groupBy("order_id").agg(
        F.sum(F.col("unit_price_minor") * F.col("quantity")).cast("bigint").alias("lines_minor")
    )
    return (
        orders.select(F.col("id").alias("order_id"), "total_minor")
        .join(lines, "order_id")
        .filter(F.col("total_minor") != F.col("lines_minor"))
    )


def category_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("category").agg(F.count("*").alias("products")).orderBy("category")
