"""Feed import over a product feed and evidence written from the part table."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockweave.functions.urls import url_key
from stockweave.operators import feed as M
from stockweave.operators import maintain as U
from stockweave.operators import match_index
from stockweave.operators.images import select_image_evidence
from stockweave.operators.quality import unique_where_not_null
from stockweave.plans.views import CATEGORY_OF_TYPE, category
from stockweave.session import scratch_path
from stockweave.sources.feeds import latest_per_key
from stockweave.sources.tables import load_spread, load_table
from stockweave.sources.versions import KeyedStore

# Listing columns, valid in both dialects. A ninth of the rows share one URL, others
# come in groups of ten copies; codes of a few rows give no id.
_LISTING = {
    "pos": "p_partkey",
    "k": "p_partkey",
    "code": "CASE WHEN p_partkey % 43 = 0 THEN '--' ELSE 'PART-' || K END",
    "title": "CASE WHEN p_partkey % 47 = 0 THEN '' ELSE p_name || ' no ' || K END",
    "group_label": "CASE WHEN p_partkey % 19 = 0 THEN 'toys' ELSE upper(C) END",
    "currency": "CASE WHEN p_partkey % 53 = 0 THEN 'USD' ELSE 'INR' END",
    "price_json": """CASE WHEN p_partkey % 11 = 0 THEN 'null' WHEN p_partkey % 13 = 0 THEN 'true'
        WHEN p_partkey % 17 = 0 THEN '1.005' WHEN p_partkey % 5 = 0 THEN '"' || R || '.50"' ELSE R END""",
    "price_minor": """CASE WHEN p_partkey % 11 = 0 OR p_partkey % 13 = 0 OR p_partkey % 17 = 0 THEN NULL
        ELSE CAST(R AS BIGINT) * 100 + CASE WHEN p_partkey % 5 = 0 THEN 50 ELSE 0 END END""",
    "url": """CASE WHEN p_partkey % 59 = 0 THEN 'http' ELSE 'https' END || '://www.Shop.example/p/'
        || CASE WHEN p_partkey % 9 = 0 THEN 'hot' WHEN p_partkey % 7 = 0 THEN 'g' || CAST(p_partkey {div} 70 AS {text})
            ELSE K END || '/?utm_source=s' || K || '&v=1#top'""",
    "url_key": """CASE WHEN p_partkey % 59 = 0 THEN 'http' ELSE 'https' END || '://shop.example/p/'
        || CASE WHEN p_partkey % 9 = 0 THEN 'hot' WHEN p_partkey % 7 = 0 THEN 'g' || CAST(p_partkey {div} 70 AS {text})
            ELSE K END || '?v=1'""",
    "store": "'Store ' || C",
    "sku": "CASE WHEN p_partkey % 15 = 0 THEN 'SKU' || CAST(p_partkey {div} 150 AS {text}) ELSE 'SKU-' || K END",
    "brand": "p_brand",
    "image_url": "'https://cdn.shopify.com/' || K || '.jpg'",
    "status": """CASE WHEN p_partkey % 61 = 0 THEN 'blocked' WHEN p_partkey % 67 = 0 THEN 'redirected_mismatch'
        ELSE 'accessible' END""",
    "http_status": "CASE WHEN p_partkey % 71 = 0 THEN 404 ELSE 200 END",
    "identity": "p_partkey % 73 <> 0",
    "backed": """CASE WHEN p_partkey % 79 = 0 THEN 'image,description' WHEN p_partkey % 83 = 0 THEN 'price,description'
        WHEN p_partkey % 89 = 0 THEN 'price,image' ELSE 'price,image,description,brand,sizes' END""",
    "content_type": "CASE WHEN p_partkey % 97 = 0 THEN 'text/html' ELSE 'image/jpeg; q=1' END",
    "known": "p_size <= 2",
}
_BASE = """SELECT *, CAST(p_partkey AS {text}) AS K, CAST(CAST(round(p_retailprice * 100) AS BIGINT) {div} 100 AS {text}) AS R
    FROM {source}"""


def _columns(text: str, div: str) -> str:
    return ", ".join(f"{e.format(text=text, div=div)} AS {n}" for n, e in _LISTING.items())


def listings(spark, d):
    part = load_spread(spark, d, "part").withColumn("C", category())
    base = _BASE.format(text="STRING", div="DIV", source="{part}")
    return spark.sql(f"SELECT {_columns('STRING', 'DIV')} FROM ({base}) b", part=part)


def _feed(rows):
    """Items as JSON, the price in the type the retailer happened to send."""
    quoted = lambda c: F.concat(F.lit('"'), F.col(c), F.lit('"'))
    fields = {
        "id": quoted("code"),
        "title": quoted("title"),
        "category": quoted("group_label"),
        "currency": quoted("currency"),
        "price_inr": F.col("price_json"),
        "canonical_url": quoted("url"),
        "source_store": quoted("store"),
        "source_product_id": quoted("sku"),
        "brand": quoted("brand"),
        "sizes": F.lit('["S","M"]'),
        "description": F.concat(F.lit('"A long enough description of the product '), F.col("title"), F.lit('"')),
        "image_urls": F.concat(F.lit('["'), F.col("image_url"), F.lit('"]')),
    }
    text = F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), c) for n, c in fields.items()])
    return rows.select("pos", F.parse_json(F.concat(F.lit("{"), text, F.lit("}"))).alias("item"))


def _pages(rows):
    checks = rows.select(
        "pos",
        F.col("code").alias("id"),
        "status",
        F.col("http_status").cast("bigint").alias("http_status"),
        F.col("url").alias("source_url"),
        F.col("identity").alias("identity_match"),
        F.split("backed", ",").alias("verified_fields"),
        F.array().cast("array<string>").alias("restored_fields"),
    )
    return latest_per_key(checks, "id", "pos").drop("pos")


def _images(rows):
    yes = F.lit(True)
    checks = rows.select(
        "pos",
        F.col("code").alias("product_id"),
        F.col("url").alias("source_url"),
        "image_url",
        F.lit("verified").alias("status"),
        F.lit(200).cast("bigint").alias("http_status"),
        "content_type",
        *[yes.alias(n) for n in ("https", "identity_match", "source_image_verified", "rendered", "csp_allowed")],
    )
    return latest_per_key(checks, "product_id", "pos").drop("pos")


def _existing(rows):
    """Products that earlier imports left active."""
    return rows.filter("known").select(
        F.concat(F.lit("source-part-"), F.col("k").cast("string")).alias("id"),
        F.col("title").alias("name"),
        "brand",
        F.lower("group_label").alias("category"),
        F.array(F.lit("M"), F.lit("S")).alias("sizes"),
        F.array().cast("array<string>").alias("colors"),
        F.col("image_url").alias("image"),
        F.col("url_key").alias("canonical_url"),
        F.col("store").alias("source_store"),
        F.col("sku").alias("source_product_id"),
    )


def _import(spark, d):
    rows = listings(spark, d)
    base = _existing(rows).withColumn("origin", F.lit(1))
    return M.classify_feed(_feed(rows), _pages(rows), _images(rows), base)


def feed_results(spark, d):
    return _results(_import(spark, d))


def _results(found):
    return found.results.select(
        "pos",
        "product_id",
        "status",
        "duplicate_of",
        "duplicate_reason",
        "failure_reason",
        F.array_join("failure_reasons", "|").alias("failure_reasons"),
        "action_taken",
    )


def feed_results_indexed(spark, d):
    """`feed_results` over a kept key index, which saw some products come, change and leave since it was built."""
    rows = listings(spark, d)
    base = _existing(rows).withColumn("origin", F.lit(1))
    number = F.substring_index("id", "-", -1).cast("bigint")
    store = KeyedStore(spark, scratch_path(spark, "match-index"), match_index.KEYS, buckets=16)
    early = base.filter(number % 3 > 0).withColumn("brand", F.when(number % 2 == 0, F.lit("old")).otherwise(F.col("brand")))
    others = _existing(rows.withColumn("known", F.col("k") % 10 == 0)).withColumn("origin", F.lit(0))
    match_index.build(store, early.unionByName(others))
    match_index.update(store, base.filter((number % 3 == 0) | (number % 2 == 0)), others.select("origin", "id"))
    found = M.classify_feed_with(_feed(rows), _pages(rows), _images(rows), match_index.owners_of(store))
    return _results(found)


def accepted_products(spark, d):
    return _import(spark, d).accepted.select(
        "id",
        "name",
        "category",
        "price_minor",
        "image",
        F.array_join("sizes", "|").alias("sizes"),
        "brand",
        "source_product_id",
        F.array_join("missing_fields", "|").alias("missing_fields"),
    )


def import_summary(spark, d):
    return M.import_summary(_import(spark, d).results)


def failure_breakdown(spark, d):
    return M.failure_breakdown(_import(spark, d).results)


def ledger_merge(spark, d):
    """Ledger after the import: kept and replaced rows told apart by their store."""
    rows = listings(spark, d)
    found = M.classify_feed(
        _feed(rows), _pages(rows), _images(rows), _existing(rows).withColumn("origin", F.lit(1))
    )
    ledger = _existing(rows).select("id", "name", "canonical_url")
    merged = U.merge_ledger(ledger, found.accepted, found.results)
    return merged.select("id", "name", "canonical_url")


def retire_records(spark, d):
    rows = listings(spark, d)
    found = M.classify_feed(
        _feed(rows), _pages(rows), _images(rows), _existing(rows).withColumn("origin", F.lit(1))
    )
    ledger = U.merge_ledger(_existing(rows).select("id", "name"), found.accepted, found.results)
    return U.retire_records(found.results, ledger).select("pos", "product_id", "failure_reason")


def image_evidence(spark, d):
    """Three candidates per product: a host that is not allowed, one that may fail, a spare one."""
    rows = listings(spark, d)
    key = F.col("k").cast("string")
    candidates = F.array(
        F.concat(F.lit("https://elsewhere.example/"), key, F.lit(".jpg")),
        F.col("image_url"),
        F.concat(F.lit("https://cdn.shopify.com/spare-"), key, F.lit(".png")),
    )
    products = rows.select(F.concat(F.lit("P"), key).alias("product_id"), F.col("url").alias("canonical_url"),
                           candidates.alias("image_urls"))
    pages = rows.select(F.concat(F.lit("P"), key).alias("id"), "status", F.col("url_key").alias("source_url"),
                        F.col("identity").alias("identity_match"), F.split("backed", ",").alias("verified_fields"))
    tried = rows.select("k", key.alias("key"), F.posexplode(candidates).alias("candidate_no", "image_url")).filter(
        "candidate_no > 0"
    )
    # the second candidate is good for even keys, the spare one for multiples of three
    good = (F.col("k") % (F.col("candidate_no") + 1)) == 0
    responses = tried.select(
        F.concat(F.lit("P"), "key").alias("product_id"),
        F.col("candidate_no").cast("bigint").alias("candidate_no"),
        "image_url",
        F.when(good, F.lit(200)).otherwise(F.lit(404)).cast("bigint").alias("http_status"),
        F.lit("image/png").alias("content_type"),
        good.alias("loaded"),
        F.when(good, F.lit(640)).otherwise(F.lit(0)).cast("bigint").alias("width"),
    )
    return select_image_evidence(products, pages, responses).select(
        "product_id", "image_url", "status", "http_status", "rendered", "csp_allowed", "identity_match",
        "failure_reason",
    )


def url_keys(spark, d):
    return load_table(spark, d, "pages").select("page_id", url_key("url").alias("url_key"))


def url_duplicates(spark, d):
    keys = load_table(spark, d, "pages").select(url_key(F.regexp_replace("url", r"\d+", "1")).alias("url_key"))
    return unique_where_not_null(keys, ["url_key"])


QUERIES = {
    "feed_results": feed_results,
    "feed_results_indexed": feed_results_indexed,
    "accepted_products": accepted_products,
    "import_summary": import_summary,
    "failure_breakdown": failure_breakdown,
    "ledger_merge": ledger_merge,
    "retire_records": retire_records,
    "image_evidence": image_evidence,
    "url_keys": url_keys,
    "url_duplicates": url_duplicates,
}

_CATEGORY = "CASE p_type " + " ".join(f"WHEN '{t}' THEN '{c}'" for t, c in CATEGORY_OF_TYPE.items()) + " ELSE 'footwear' END"
_FEED_SQL = f"""WITH RECURSIVE b AS ({_BASE.format(text='VARCHAR', div='//', source=f'(SELECT *, {_CATEGORY} AS C FROM part)')}),
f AS (SELECT {_columns('VARCHAR', '//')},
    CASE WHEN code = '--' THEN NULL ELSE 'source-' || lower(code) END AS product_id FROM b),
ev AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY code ORDER BY pos DESC) = 1),
v AS (SELECT f.*, string_split(ev.backed, ',') AS ok, f.k % 19 <> 0 AS category_ok,
    CASE WHEN ev.status = 'accessible' AND ev.http_status <> 200 THEN 'SOURCE_INACCESSIBLE'
        WHEN ev.status = 'blocked' THEN 'SOURCE_BLOCKED'
        WHEN ev.status = 'redirected_mismatch' THEN 'REDIRECTED_TO_DIFFERENT_PRODUCT'
        WHEN NOT ev.identity THEN 'PRODUCT_MISMATCH' END AS page_failure,
    ev.url_key = f.url_key AS url_matches,
    ev.image_url = f.image_url AND ev.url_key = f.url_key AND ev.content_type LIKE 'image/%'
        AND list_contains(string_split(ev.backed, ','), 'image') AS image_ok
    FROM f JOIN ev ON ev.code = f.code),
w AS (SELECT *, list_distinct_ordered AS reasons FROM (SELECT *, list_filter([
    CASE WHEN k % 59 = 0 OR NOT url_matches THEN 'SOURCE_URL_INVALID' END,
    page_failure,
    CASE WHEN title = '' THEN 'VALIDATION_FAILED' END,
    CASE WHEN NOT category_ok THEN 'INVALID_CATEGORY' END,
    CASE WHEN currency <> 'INR' OR (price_minor IS NULL AND k % 11 <> 0) THEN 'PRICE_INVALID' END,
    CASE WHEN price_minor IS NULL THEN 'PRICE_MISSING' END,
    CASE WHEN NOT list_contains(ok, 'price') THEN 'PRICE_UNVERIFIED' END,
    CASE WHEN NOT list_contains(ok, 'description') THEN 'DETAILS_INSUFFICIENT' END,
    CASE WHEN NOT image_ok THEN 'IMAGE_BROKEN' END,
    CASE WHEN product_id IS NULL AND title <> '' THEN 'VALIDATION_FAILED' END
    ], lambda x: x IS NOT NULL) AS list_distinct_ordered FROM v) z),
keys AS (SELECT pos, product_id, unnest([{{'rule': 1, 'key': url_key}}, {{'rule': 2, 'key': lower(store) || chr(1) || lower(sku)}},
    {{'rule': 3, 'key': CASE WHEN title <> '' THEN lower(title) || chr(1) || brand || chr(1)
        || CASE WHEN category_ok THEN group_label ELSE '' END || chr(1) || image_url END}}]) AS q FROM w),
asked AS (SELECT pos, q.rule AS rule, q.key AS key FROM keys WHERE q.key IS NOT NULL),
reg AS (SELECT keys.pos, keys.product_id, q.rule AS rule, q.key AS key FROM keys JOIN w ON w.pos = keys.pos
    WHERE q.key IS NOT NULL AND keys.product_id IS NOT NULL AND (q.rule <> 3 OR category_ok)),
old AS (SELECT 'source-part-' || CAST(k AS VARCHAR) AS id, f.* FROM f WHERE known),
okeys AS (SELECT id, unnest([{{'rule': 1, 'key': url_key}}, {{'rule': 2, 'key': lower(store) || chr(1) || lower(sku)}},
    {{'rule': 3, 'key': CASE WHEN title <> '' THEN lower(title) || chr(1) || brand || chr(1) || group_label
        || chr(1) || image_url END}}]) AS q FROM old),
ex AS (SELECT asked.pos, min({{'id': okeys.id, 'rule': asked.rule}}) AS m FROM asked
    JOIN okeys ON okeys.q.rule = asked.rule AND okeys.q.key = asked.key GROUP BY asked.pos),
live AS (SELECT w.pos FROM w LEFT JOIN ex ON ex.pos = w.pos WHERE len(reasons) = 0 OR ex.pos IS NOT NULL
    UNION SELECT asked.pos FROM live JOIN reg ON reg.pos = live.pos
        JOIN asked ON asked.rule = reg.rule AND asked.key = reg.key AND asked.pos > reg.pos),
own AS (SELECT rule, key, min({{'pos': reg.pos, 'id': reg.product_id}}) AS o FROM reg
    WHERE pos IN (SELECT pos FROM live) GROUP BY rule, key),
inf AS (SELECT asked.pos, min({{'rule': asked.rule, 'id': own.o.id}}) AS m FROM asked
    JOIN own ON own.rule = asked.rule AND own.key = asked.key AND own.o.pos < asked.pos GROUP BY asked.pos),
x AS (SELECT w.*, coalesce(inf.m.id, ex.m.id) AS duplicate_of, coalesce(inf.m.rule, ex.m.rule) AS rule,
    CASE WHEN coalesce(inf.m.id, ex.m.id) IS NULL THEN CASE WHEN len(reasons) > 0 THEN 'REJECTED' ELSE 'ACCEPTED' END
        WHEN coalesce(inf.m.id, ex.m.id) = product_id AND product_id IN (SELECT id FROM old) THEN 'EXISTING'
        ELSE 'DUPLICATE' END AS status_of
    FROM w LEFT JOIN inf ON inf.pos = w.pos LEFT JOIN ex ON ex.pos = w.pos),
res AS (SELECT pos, k, product_id, status_of AS status, duplicate_of, price_minor, title, image_url, brand, sku, ok, url, group_label,
    CASE WHEN duplicate_of IS NOT NULL THEN CASE rule WHEN 1 THEN 'same normalized canonical source URL'
        WHEN 2 THEN 'same retailer and retailer product ID'
        ELSE 'same normalized title, brand, category, variants and image' END END AS duplicate_reason,
    CASE WHEN status_of = 'DUPLICATE' THEN list_append(reasons, 'DUPLICATE_PRODUCT') ELSE reasons END AS reasons,
    CASE status_of WHEN 'EXISTING' THEN 'kept existing validated product; incoming row did not overwrite it'
        WHEN 'DUPLICATE' THEN 'not inserted; existing product retained'
        WHEN 'REJECTED' THEN 'not inserted; excluded from active catalog'
        ELSE 'inserted into active import set' END AS action_taken FROM x) """

_TRACKING = "'gclid','fbclid','mc_cid','mc_eid','ref','tag','linkcode','srsltid'"


def _url_key_sql(source: str) -> str:
    """Scheme, host, path and query by pattern; pairs decoded, sorted, encoded again."""
    return rf"""u AS (SELECT page_id, regexp_extract(url, '^([A-Za-z]+):', 1) AS scheme,
        regexp_replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)), ':\d*$', ''), '^www\.', '') AS host,
        regexp_replace(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
        regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS query FROM ({source}) s),
    kept AS (SELECT *, list_sort(list_transform(list_filter(string_split(query, '&'), lambda p: p <> ''
            AND NOT lower(split_part(p, '=', 1)) IN ({_TRACKING})
            AND NOT starts_with(lower(p), 'utm_') AND NOT starts_with(lower(p), 'ref_')),
        lambda p: [url_decode(split_part(p, '=', 1)), url_decode(substr(p, length(split_part(p, '=', 1)) + 2))])) AS pairs FROM u),
    keyed AS (SELECT page_id, scheme || '://' || host || CASE WHEN path = '' THEN '/' ELSE path END
        || CASE WHEN len(pairs) > 0 THEN '?' || array_to_string(list_transform(pairs,
            lambda p: url_encode(p[1]) || '=' || url_encode(p[2])), '&') ELSE '' END AS url_key FROM kept)"""


ORACLE = {
    "feed_results": _FEED_SQL + """SELECT pos, product_id, status, duplicate_of, duplicate_reason,
        reasons[1] AS failure_reason, array_to_string(reasons, '|') AS failure_reasons, action_taken FROM res""",
    "accepted_products": _FEED_SQL + """SELECT product_id AS id, title AS name, lower(group_label) AS category,
        price_minor, image_url AS image, CASE WHEN list_contains(ok, 'sizes') THEN 'S|M' ELSE '' END AS sizes,
        CASE WHEN list_contains(ok, 'brand') THEN brand END AS brand, sku AS source_product_id,
        array_to_string(list_filter(['color', CASE WHEN NOT list_contains(ok, 'sizes') THEN 'sizes' END,
            CASE WHEN NOT list_contains(ok, 'brand') THEN 'brand' END, 'subcategory', 'mrp_inr', 'discount_percent',
            'material', 'fit', 'rating'], lambda x: x IS NOT NULL), '|') AS missing_fields
        FROM res WHERE status = 'ACCEPTED'""",
    "import_summary": _FEED_SQL + """SELECT count(*) AS urls_received,
        count(*) FILTER (status = 'ACCEPTED') AS successfully_added,
        count(*) FILTER (status IN ('ACCEPTED', 'EXISTING')) AS valid_imports,
        count(*) FILTER (status = 'EXISTING') AS already_existed,
        count(*) FILTER (status = 'DUPLICATE') AS duplicates,
        count(*) FILTER (status = 'REJECTED') AS rejected FROM res""",
    "failure_breakdown": _FEED_SQL + """, q AS (SELECT unnest(reasons) AS reason FROM res
        WHERE status IN ('REJECTED', 'DUPLICATE')) SELECT reason, count(*) AS occurrences FROM q GROUP BY reason""",
    "ledger_merge": _FEED_SQL + """SELECT id, title AS name, url_key AS canonical_url FROM old
        WHERE id NOT IN (SELECT product_id FROM res WHERE status = 'ACCEPTED')
        UNION ALL SELECT product_id, title, url FROM res WHERE status = 'ACCEPTED'""",
    "retire_records": _FEED_SQL + """SELECT pos, product_id, reasons[1] AS failure_reason FROM res
        WHERE status = 'REJECTED' AND (product_id IS NULL OR product_id NOT IN (SELECT id FROM old))""",
    "image_evidence": _FEED_SQL + """, i AS (SELECT *, status = 'accessible' AND identity
            AND list_contains(string_split(backed, ','), 'image') AS page_ok, CAST(k AS VARCHAR) AS s FROM f)
        SELECT 'P' || s AS product_id,
            CASE WHEN NOT page_ok THEN 'https://elsewhere.example/' || s || '.jpg' WHEN k % 2 = 0 THEN image_url
                ELSE 'https://cdn.shopify.com/spare-' || s || '.png' END AS image_url,
            CASE WHEN page_ok AND (k % 2 = 0 OR k % 3 = 0) THEN 'verified' ELSE 'rejected' END AS status,
            CAST(CASE WHEN NOT page_ok THEN NULL WHEN k % 2 = 0 OR k % 3 = 0 THEN 200 ELSE 404 END AS BIGINT) AS http_status,
            page_ok AND (k % 2 = 0 OR k % 3 = 0) AS rendered, page_ok AS csp_allowed, page_ok AS identity_match,
            CASE WHEN NOT page_ok THEN 'PRODUCT_MISMATCH' WHEN k % 2 = 0 OR k % 3 = 0 THEN NULL
                ELSE 'IMAGE_BROKEN' END AS failure_reason FROM i""",
    "url_keys": "WITH " + _url_key_sql("SELECT page_id, url FROM pages") + " SELECT page_id, url_key FROM keyed",
    "url_duplicates": "WITH " + _url_key_sql(
        r"SELECT page_id, regexp_replace(url, '\d+', '1', 'g') AS url FROM pages"
    ) + " SELECT url_key, count(*) AS occurrences FROM keyed GROUP BY url_key HAVING count(*) > 1",
}
ORACLE["feed_results_indexed"] = ORACLE["feed_results"]
