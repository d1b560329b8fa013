"""Image evidence from a table of fetched responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.functions import text, urls
from stockweave.operators.feed_rules import is_image_type
from stockweave.schemas import IMAGE_EVIDENCE


def _no_null(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def select_image_evidence(
    products: DataFrame, pages: DataFrame, responses: DataFrame, hosts: tuple[str, ...] = urls.IMAGE_HOSTS
) -> DataFrame:
    """One evidence row per product: the first valid candidate, else the last tried, else a default.

    `products` has product_id, canonical_url and image_urls; a candidate is tried
    when it is https on an allowed host and the page is the product's. Candidates
    are reduced with min/max per product, never collected. Pages and responses grow with the
    products, and their size on disk says little of it, so no side is left to be broadcast.
    """
    page = pages.select(
        F.col("id").alias("product_id"),
        (
            _no_null(F.col("status") == "accessible") & _no_null(F.col("identity_match"))
        ).alias("_page_ok"),
        urls.url_key("source_url").alias("_page_key"),
        _no_null(F.array_contains("verified_fields", "image")).alias("source_image_verified"),
    )
    rows = products.join(page.hint("merge"), "product_id", "left").select(
        "product_id",
        F.col("canonical_url").alias("source_url"),
        "image_urls",
        _no_null(F.col("source_image_verified")).alias("source_image_verified"),
        (
            _no_null(F.col("_page_ok"))
            & _no_null(F.col("_page_key") == urls.url_key("canonical_url"))
            & _no_null(F.col("source_image_verified"))
        ).alias("identity_match"),
    )
    candidates = rows.filter("identity_match").select(
        "product_id", F.posexplode("image_urls").alias("candidate_no", "image_url")
    )
    allowed = F.col("image_url").startswith("https://") & urls.is_https_on("image_url", hosts)
    tried = candidates.filter(allowed).withColumn("candidate_no", F.col("candidate_no").cast("bigint"))
    loaded = tried.join(responses.hint("merge"), ["product_id", "candidate_no", "image_url"], "left")
    rendered = _no_null(F.col("loaded")) & _no_null(F.col("width") > 0)
    valid = rendered & _no_null(F.col("http_status") == 200) & is_image_type(F.col("content_type"))
    loaded = loaded.select(
        "product_id",
        valid.alias("valid"),
        F.struct("candidate_no", "image_url", "http_status", "content_type", rendered.alias("rendered")).alias("c"),
    )
    chosen = loaded.groupBy("product_id").agg(
        F.min(F.when(F.col("valid"), F.col("c"))).alias("good"), F.max("c").alias("last")
    )
    joined = rows.join(chosen.hint("merge"), "product_id", "left")
    good, pick = F.col("good").isNotNull(), F.coalesce("good", "last")
    tried_any = pick.isNotNull()
    first_image = F.try_element_at("image_urls", F.lit(1))
    broken = F.when(~_no_null(pick["http_status"] == 200), F.lit("IMAGE_BROKEN")).otherwise(
        F.lit("IMAGE_INVALID_CONTENT")
    )
    untried = (
        F.when(~F.col("identity_match"), F.lit("PRODUCT_MISMATCH"))
        .when(text.blank_if_null(first_image) == "", F.lit("IMAGE_MISSING"))
        .when(urls.host(first_image) == "", F.lit("IMAGE_BROKEN"))
        .when(~urls.host(first_image).isin(*hosts), F.lit("IMAGE_CSP_BLOCKED"))
        .otherwise(F.lit("IMAGE_BROKEN"))
    )
    none = F.lit(None)
    evidence = {
        "product_id": F.col("product_id"),
        "source_url": F.col("source_url"),
        "image_url": F.when(tried_any, pick["image_url"]).otherwise(first_image),
        "status": F.when(good, F.lit("verified")).otherwise(F.lit("rejected")),
        "http_status": pick["http_status"],
        "content_type": F.when(pick["content_type"] != "", pick["content_type"]),
        "https": tried_any,
        "identity_match": F.col("identity_match"),
        "source_image_verified": F.col("source_image_verified"),
        "rendered": _no_null(pick["rendered"]),
        "csp_allowed": tried_any,
        "checked_at": none,
        "failure_reason": F.when(tried_any, F.when(~good, broken)).otherwise(untried),
    }
    return joined.select(*[evidence[f.name].cast(f.dataType).alias(f.name) for f in IMAGE_EVIDENCE])
