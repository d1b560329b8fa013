"""Table shapes."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Enumerations and limits of the catalog and of checkout.
CATEGORIES = ("men", "women", "kids", "accessories", "footwear")
ORDER_SOURCES = ("synthetic", "visitor")
MAX_BODY_BYTES = 16_384
MAX_LINES = 20
MAX_QUANTITY = 10
MAX_UNITS = 50
MAX_VARIANT_TEXT = 60

_STRINGS = ArrayType(StringType())


def _struct(*fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


RAW_COLUMNS = ("id", "name", "category", "description", "price_inr", "image", "alt", "sizes", "colors", "featured")

CLEAN_PRODUCT = _struct(
    ("id", StringType()),
    ("name", StringType()),
    ("category", StringType()),
    ("description", StringType()),
    ("price_minor", LongType()),
    ("image", StringType()),
    ("alt", StringType()),
    ("sizes", _STRINGS),
    ("colors", _STRINGS),
    ("featured", BooleanType()),
)

PRODUCT = StructType(
    CLEAN_PRODUCT.fields
    + _struct(
        ("brand", StringType()),
        ("subcategory", StringType()),
        ("mrp_minor", LongType()),
        ("discount_percent", IntegerType()),
        ("material", StringType()),
        ("fit", StringType()),
        ("rating_value", DoubleType()),
        ("rating_scale", DoubleType()),
        ("rating_count", LongType()),
        ("source_store", StringType()),
        ("source_product_id", StringType()),
        ("canonical_url", StringType()),
        ("verification_status", StringType()),
        ("missing_fields", _STRINGS),
    ).fields
)
PRODUCT_COLUMNS = tuple(PRODUCT.fieldNames())

LEDGER = StructType(PRODUCT.fields + _struct(("source_code", StringType()), ("image_urls", _STRINGS)).fields)

UNAVAILABLE = _struct(("id", StringType()), ("reason", StringType()))
RETIRED = _struct(
    ("product_id", StringType()),
    ("name", StringType()),
    ("source_url", StringType()),
    ("failure_reason", _STRINGS),
    ("retired_at", TimestampType()),
)
ORDERS = _struct(
    ("id", StringType()),
    ("idempotency_key", StringType()),
    ("request_hash", StringType()),
    ("source", StringType()),
    ("total_minor", LongType()),
    ("created_at", TimestampType()),
)
ORDER_ITEMS = _struct(
    ("order_id", StringType()),
    ("line_no", IntegerType()),
    ("product_id", StringType()),
    ("product_name", StringType()),
    ("category", StringType()),
    ("unit_price_minor", LongType()),
    ("quantity", IntegerType()),
    ("size", StringType()),
    ("color", StringType()),
)
SUBMISSIONS = _struct(("submission_seq", LongType()), ("idempotency_key", StringType()), ("body", StringType()))

PAGE_EVIDENCE = _struct(
    ("id", StringType()),
    ("status", StringType()),
    ("http_status", LongType()),
    ("source_url", StringType()),
    ("identity_match", BooleanType()),
    ("verified_fields", _STRINGS),
    ("restored_fields", _STRINGS),
)
IMAGE_EVIDENCE = _struct(
    ("product_id", StringType()),
    ("source_url", StringType()),
    ("image_url", StringType()),
    ("status", StringType()),
    ("http_status", LongType()),
    ("content_type", StringType()),
    ("https", BooleanType()),
    ("identity_match", BooleanType()),
    ("source_image_verified", BooleanType()),
    ("rendered", BooleanType()),
    ("csp_allowed", BooleanType()),
    ("checked_at", StringType()),
    ("failure_reason", StringType()),
)
IMAGE_RESPONSES = _struct(
    ("product_id", StringType()),
    ("image_url", StringType()),
    ("candidate_no", LongType()),
    ("http_status", LongType()),
    ("content_type", StringType()),
    ("loaded", BooleanType()),
    ("width", LongType()),
)
