"""Feed rows against page and image evidence: keys, typed fields, reason codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.functions import identity, money, text, urls
from stockweave.schemas import CATEGORIES

# Detail fields in report order, fields an import may lack and the
# evidence that backs them, page statuses and their reason codes.
DETAIL_FIELDS = (
    "description",
    "material",
    "fit",
    "color",
    "sizes",
    "subcategory",
    "style",
    "features",
    "product_type",
    "specifications",
    "variants",
)
OPTIONAL_FIELDS = (
    ("description", "description"),
    ("color", "color"),
    ("sizes", "sizes"),
    ("brand", "brand"),
    ("subcategory", "subcategory"),
    ("mrp_inr", "mrp"),
    ("discount_percent", "discount_percent"),
    ("material", "material"),
    ("fit", "fit"),
    ("rating", "rating"),
)
PAGE_FAILURES = {
    "blocked": "SOURCE_BLOCKED",
    "inaccessible": "SOURCE_INACCESSIBLE",
    "no_product_content": "SOURCE_NOT_PRODUCT",
    "redirected_mismatch": "REDIRECTED_TO_DIFFERENT_PRODUCT",
}
MAX_TITLE = 120
MAX_SIZE_LABEL = 40
MAX_COLOR = 100


# All fields read more than once; their JSON text tells type and emptiness.
FIELDS = (
    "id", "title", "category", "currency", "price_inr", "mrp_inr", "discount_percent", "description", "color",
    "sizes", "brand", "subcategory", "material", "fit", "rating", "source_product_id", "source_store",
    "canonical_url", "provided_url", "image_urls", "style", "features", "product_type", "specifications", "variants",
)
_EMPTY = ("null", '""', "[]")
_FALSY = (*_EMPTY, "{}", "0", "0.0", "false")


class Item:
    """Typed access to the VARIANT column of a feed row.

    All fields are taken out in one cast (`unpack`): a path that leads nowhere is
    slow to follow, and most items lack most fields. Their JSON text then answers
    for type and emptiness; their value as text is taken once, however many rules read it.
    """

    def __init__(self, name: str = "item", unpacked: str = "_fields"):
        self.name = name
        self.unpacked = unpacked
        self.texts = unpacked + "_json"
        self.values = unpacked + "_text"

    def unpack(self, rows: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
        shape = "struct<" + ",".join(f"{f}:variant" for f in fields) + ">"
        rows = rows.withColumn(self.unpacked, F.try_variant_get(self.name, "$", shape))
        values = [F.try_variant_get(self.raw(f), "$", "string").alias(f) for f in fields]
        texts = [F.to_json(self.raw(f)).alias(f) for f in fields]
        return rows.withColumns({self.texts: F.struct(*texts), self.values: F.struct(*values)})

    def drop(self, rows: DataFrame) -> DataFrame:
        return rows.drop(self.unpacked, self.texts, self.values)

    def raw(self, field: str) -> Column:
        return F.col(self.unpacked)[field]

    def text(self, field: str) -> Column:
        return F.col(self.values)[field]

    def list(self, field: str) -> Column:
        return F.try_variant_get(self.raw(field), "$", "array<variant>")

    def json(self, field: str) -> Column:
        return text.blank_if_null(F.col(self.texts)[field])

    def present(self, field: str) -> Column:
        return ~self.json(field).isin("", "null")

    def given(self, field: str) -> Column:
        """Present and not null, "" or []."""
        return ~self.json(field).isin("", *_EMPTY)

    def truthy(self, field: str) -> Column:
        return ~self.json(field).isin("", *_FALSY)

    def is_string(self, field: str) -> Column:
        return self.json(field).startswith('"')

    def is_list(self, field: str) -> Column:
        return self.json(field).startswith("[")

    def is_object(self, field: str) -> Column:
        return self.json(field).startswith("{")

    def is_integer(self, field: str) -> Column:
        """A JSON integer: 2.0 is none, so the VARIANT type has to say."""
        return _no_null(F.schema_of_variant(self.raw(field)) == "BIGINT")

    def string(self, field: str) -> Column:
        """Text of a JSON string; NULL for any other type."""
        return F.when(self.is_string(field), self.text(field))

    def text_or_blank(self, field: str) -> Column:
        return F.when(self.truthy(field), text.blank_if_null(self.text(field))).otherwise(F.lit(""))

    def strings(self, field: str) -> Column:
        """Elements of a JSON list as text; empty for anything else."""
        texts = F.transform(self.list(field), lambda v: text.blank_if_null(F.try_variant_get(v, "$", "string")))
        return F.coalesce(texts, F.array().cast("array<string>"))


def _no_null(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def key_feed(feed: DataFrame) -> DataFrame:
    """Code, stable id, source URL and title of each row."""
    item = Item(unpacked="_key")
    canonical = item.truthy("canonical_url")
    url = F.when(canonical, item.text("canonical_url")).when(
        item.truthy("provided_url"), item.text("provided_url")
    )
    is_text = F.when(canonical, item.is_string("canonical_url")).otherwise(item.is_string("provided_url"))
    rows = item.unpack(feed, ("id", "title", "canonical_url", "provided_url")).withColumns(
        {
            "is_object": _no_null(F.schema_of_variant("item").startswith("OBJECT")),
            "code": text.strip(item.text_or_blank("id")),
            "source_url": url,
            "_url_is_text": is_text,
            "title": text.squash(item.text_or_blank("title")),
        }
    )
    keyed = rows.withColumns(
        {"product_id": identity.stable_id("code"), "source_key": urls.url_key("source_url")}
    )
    return item.drop(keyed)


def key_of(url: Column) -> Column:
    """The key of a URL beside a keyed row; most often it is the row's own URL, whose key is there."""
    return F.when(url == F.col("source_url"), F.col("source_key")).otherwise(urls.url_key(url))


def join_evidence(keyed: DataFrame, pages: DataFrame, images: DataFrame) -> DataFrame:
    """Page and image evidence of each row's code; both sides hold one row per code.

    The two are put together first, so the feed meets them in one join whose left
    side may be split when a code is hot. Neither is forced into a broadcast:
    evidence grows with the feed.
    """
    page = pages.select(F.col("id").alias("_page_code"), F.struct(*pages.columns).alias("page"))
    image = images.select(F.col("product_id").alias("_image_code"), F.struct(*images.columns).alias("image"))
    evidence = page.join(image, F.col("_page_code") == F.col("_image_code"), "full").select(
        F.coalesce("_page_code", "_image_code").alias("code"), "page", "image"
    )
    return keyed.join(evidence, "code", "left")


def verified_details(item: Item, verified: Column) -> Column:
    """Detail fields the page backs, with an actual value, in report order."""
    found = []
    for field in DETAIL_FIELDS:
        backed = F.array_contains(verified, field) & item.given(field)
        if field == "description":
            backed = backed & text.meaningful_description(item.text(field), item.text_or_blank("title"))
        found.append(F.when(backed, F.lit(field)))
    return text.present(*found)


def source_failure(page: Column) -> Column:
    """Reason code of the page check, NULL when the page is the product's."""
    code = F.when(
        (page["status"] == "accessible") & ~_no_null(page["http_status"] == 200), F.lit("SOURCE_INACCESSIBLE")
    )
    for status, reason in PAGE_FAILURES.items():
        code = code.when(page["status"] == status, F.lit(reason))
    code = code.when(~_no_null(page["status"] == "accessible"), F.lit("SOURCE_INACCESSIBLE"))
    return code.when(~_no_null(page["identity_match"]), F.lit("PRODUCT_MISMATCH"))


def is_image_type(content_type: Column) -> Column:
    mime = F.substring_index(F.lower(text.blank_if_null(content_type)), ";", 1)
    return mime.startswith("image/")


def _amount(item: Item, field: str) -> Column:
    """Struct of paise and validity; a missing amount is valid and NULL."""
    absent = item.json(field).isin("", "null", '""')
    number = item.is_string(field) | item.json(field).rlike("^[-0-9]")
    return text.let(
        F.when(number, money.amount_to_paise(item.text(field))),
        lambda paise: F.struct(paise.alias("paise"), (absent | paise.isNotNull()).alias("valid")),
    )


def validate_feed(keyed: DataFrame, pages: DataFrame, images: DataFrame) -> DataFrame:
    """All base reasons of each row, in rule order, with the values a product needs."""
    item = Item()
    rows = item.unpack(join_evidence(keyed, pages, images))
    page, image = F.col("page"), F.col("image")
    category = F.lower(text.strip(item.text_or_blank("category")))
    bad_size = F.exists(
        item.list("sizes"),
        lambda v: (F.schema_of_variant(v) != "STRING")
        | (text.strip(F.try_variant_get(v, "$", "string")) == "")
        | (F.length(F.try_variant_get(v, "$", "string")) > MAX_SIZE_LABEL),
    )
    first_image = F.try_element_at(item.list("image_urls"), F.lit(1))
    rows = rows.withColumns(
        {
            "verified": F.coalesce(page["verified_fields"], F.array().cast("array<string>")),
            "restored": F.coalesce(page["restored_fields"], F.array().cast("array<string>")),
            "category": F.when(category.isin(*CATEGORIES), category),
            "_price": _amount(item, "price_inr"),
            "_mrp": _amount(item, "mrp_inr"),
            "_discount_ok": item.is_integer("discount_percent")
            & _no_null(item.text("discount_percent").try_cast("bigint").between(0, 100)),
            "_sizes_ok": ~item.truthy("sizes") | (item.is_list("sizes") & ~_no_null(bad_size)),
            "_has_images": item.is_list("image_urls") & item.truthy("image_urls"),
            "store": text.squash(item.text_or_blank("source_store")),
            "source_id": text.strip(item.text_or_blank("source_product_id")),
        }
    )
    rows = rows.withColumns(
        {
            "details": verified_details(item, F.col("verified")),
            "url_valid": F.col("_url_is_text") & _no_null(urls.is_https("source_url")),
            "image_url": F.when(
                F.col("_has_images") & _no_null(F.schema_of_variant(first_image) == "STRING"),
                F.try_variant_get(first_image, "$", "string"),
            ).otherwise(F.lit("")),
            "price_minor": F.col("_price.paise"),
            "mrp_minor": F.col("_mrp.paise"),
            "price_verified": F.array_contains("verified", "price"),
        }
    )
    image_reason = F.when(F.col("image_url") != "", F.lit("IMAGE_BROKEN")).otherwise(F.lit("IMAGE_MISSING"))
    rows = rows.withColumn(
        "evidence_ok",
        _no_null(image["status"] == "verified")
        & _no_null(image["image_url"] == F.col("image_url"))
        & _no_null(key_of(image["source_url"]) == F.col("source_key"))
        & _no_null(image["http_status"] == 200)
        & is_image_type(image["content_type"])
        & _no_null(image["https"])
        & _no_null(image["identity_match"])
        & _no_null(image["source_image_verified"])
        & _no_null(image["rendered"])
        & _no_null(image["csp_allowed"])
        & F.array_contains("verified", "image"),
    )
    no_details = F.size("details") == 0
    has_description = item.truthy("description")
    host_ok = urls.is_https_on("image_url", urls.IMAGE_HOSTS)
    page_url = key_of(page["source_url"])

    def fails(condition: Column, reason) -> Column:
        return F.when(condition, F.lit(reason) if isinstance(reason, str) else reason)

    reasons = [
        fails(~F.col("is_object"), "VALIDATION_FAILED"),
        fails(~F.col("url_valid") | (page_url != F.col("source_key")), "SOURCE_URL_INVALID"),
        source_failure(page),
        fails(~F.length("title").between(1, MAX_TITLE), "VALIDATION_FAILED"),
        fails(F.col("category").isNull(), "INVALID_CATEGORY"),
        fails(~_no_null(item.string("currency") == "INR"), "PRICE_INVALID"),
        fails(~F.col("_price.valid"), "PRICE_INVALID"),
        fails(F.col("price_minor").isNull(), "PRICE_MISSING"),
        fails(~F.col("price_verified"), "PRICE_UNVERIFIED"),
        fails(~F.col("_mrp.valid"), "PRICE_INVALID"),
        fails(item.present("discount_percent") & ~F.col("_discount_ok"), "VALIDATION_FAILED"),
        fails(~F.col("_sizes_ok"), "VALIDATION_FAILED"),
        fails(
            item.present("color") & ~_no_null(F.length(item.string("color")) <= MAX_COLOR), "VALIDATION_FAILED"
        ),
        fails(item.present("rating") & ~item.is_object("rating"), "VALIDATION_FAILED"),
        fails(no_details & ~has_description, "DESCRIPTION_MISSING"),
        fails(no_details & has_description, "DETAILS_INSUFFICIENT"),
        fails(~F.col("_has_images"), "IMAGE_MISSING"),
        fails(~host_ok, image_reason),
        fails(~F.col("evidence_ok"), image_reason),
        fails(F.col("store") == "", "VALIDATION_FAILED"),
        # a row without a usable id cannot be stored
        fails(F.col("product_id").isNull(), "VALIDATION_FAILED"),
    ]
    rows = rows.withColumn("reasons", F.when(F.col("is_object"), text.present(*reasons)).otherwise(F.array(F.lit("VALIDATION_FAILED"))))
    return rows.withColumn(
        "validation",
        F.struct(
            F.length("title").between(1, MAX_TITLE).alias("valid_title"),
            F.col("url_valid").alias("valid_source_url"),
            _no_null((page["status"] == "accessible") & (page["http_status"] == 200)).alias("source_accessible"),
            _no_null(page["identity_match"]).alias("identity_matched"),
            (F.col("price_minor").isNotNull() & F.col("price_verified")).alias("verified_price"),
            F.col("evidence_ok").alias("working_real_image"),
            (~no_details).alias("meaningful_source_verified_details"),
            F.col("category").isNotNull().alias("valid_category"),
            F.col("details").alias("verified_detail_fields"),
        ),
    )


def product_columns() -> dict[str, Column]:
    """Catalog columns of an accepted row; whatever the page does not back stays blank."""
    item = Item()
    backed = lambda f: F.array_contains("verified", f)
    when_backed = lambda f: F.when(backed(f), item.text(f))
    color = text.strip(F.when(backed("color"), item.string("color")))
    rating = lambda f, kind: F.when(
        backed("rating") & item.is_object("rating"), F.try_variant_get(item.raw("rating"), f"$.{f}", kind)
    )
    missing = [F.when(~backed(e) | ~item.given(f), F.lit(f)) for f, e in OPTIONAL_FIELDS]
    missing.append(F.when(F.col("source_id") == "", F.lit("source_product_id")))
    description = F.when(backed("description") & F.array_contains("details", "description"), item.text("description"))
    return {
        "id": F.col("product_id"),
        "name": F.col("title"),
        "category": F.col("category"),
        "description": text.blank_if_null(description),
        "price_minor": F.col("price_minor"),
        "image": F.col("image_url"),
        "alt": F.concat("title", F.lit(" product image")),
        "sizes": F.when(backed("sizes"), item.strings("sizes")).otherwise(F.array().cast("array<string>")),
        "colors": F.when(text.blank_if_null(color) != "", F.array(color)).otherwise(F.array().cast("array<string>")),
        "featured": F.lit(False),
        "brand": when_backed("brand"),
        "subcategory": when_backed("subcategory"),
        "mrp_minor": F.when(backed("mrp") | F.array_contains("restored", "mrp_inr"), F.col("mrp_minor")),
        "discount_percent": F.when(
            backed("discount_percent") & F.col("_discount_ok"), item.text("discount_percent").try_cast("int")
        ),
        "material": when_backed("material"),
        "fit": when_backed("fit"),
        "rating_value": rating("value", "double"),
        "rating_scale": rating("scale", "double"),
        "rating_count": rating("count", "bigint"),
        "source_store": F.col("store"),
        "source_product_id": F.when(F.col("source_id") != "", F.col("source_id")),
        "canonical_url": F.col("source_url"),
        "verification_status": F.lit("verified"),
        "missing_fields": text.present(*missing),
        "source_code": F.col("code"),
        "image_urls": item.strings("image_urls"),
    }
