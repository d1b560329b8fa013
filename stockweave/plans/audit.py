"""Audits of documents and web pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockweave.functions import urls
from stockweave.operators import audits as H
from stockweave.sources.tables import load_spread, load_table


def contact_audit(spark, d):
    return H.contact_audit(load_spread(spark, d, "documents", "doc_id", "text"), "doc_id")


def contact_audit_pages(spark, d):
    return H.contact_audit(load_spread(spark, d, "pages", "page_id", "html"), "page_id", "html")


def contact_audit_chats(spark, d):
    """Turns of users only count as public text for phone numbers."""
    turns = load_table(spark, d, "conversations").withColumn(
        "turn_id", F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    )
    return H.contact_audit(turns, "turn_id", "text", F.col("role") == "user")


def _site(spark, d):
    return load_spread(spark, d, "pages").select(
        "page_id", "html", urls.host("url").alias("site"), urls.path("url").alias("path")
    )


def reference_audit(spark, d):
    """References to pages that the crawl does not hold for the same host."""
    pages = _site(spark, d)
    broken = H.reference_audit(pages, pages.select("site", "path"), "page_id", "path", site="site")
    return broken.groupBy("page_id", "target").agg(F.count("*").alias("references"))


def images_without_alt(spark, d):
    return H.images_without_alt(_site(spark, d), "page_id")


# One image per page, by page_id % 4: a text, a text that looks like an attribute, a title that looks
# like one, and an empty text beside one that is given twice, the last time empty.
_IMAGES = (
    '<img src="/a.png" alt="text">',
    '<img alt="a src=x.png b" src="/b.png">',
    '<img title="no alt=here" src="/c.png">',
    "<IMG ALT='' SRC=/d.png><img alt=x src=/e.png alt=''>",
)


def images_without_alt_mixed(spark, d):
    pages = _site(spark, d)
    image = F.get(F.array(*[F.lit(i) for i in _IMAGES]), (F.col("page_id") % 4).cast("int"))
    return H.images_without_alt(pages.withColumn("html", F.concat("html", image)), "page_id")


QUERIES = {
    "contact_audit": contact_audit,
    "contact_audit_pages": contact_audit_pages,
    "contact_audit_chats": contact_audit_chats,
    "reference_audit": reference_audit,
    "images_without_alt": images_without_alt,
    "images_without_alt_mixed": images_without_alt_mixed,
}


def _contact_sql(key: str, content: str, source: str, public: str = "true") -> str:
    # a neighbour that is no digit stands for the look-arounds
    return rf"""SELECT {key}, '{H.EMAIL_ISSUE}' AS issue FROM {source}
            WHERE len(list_filter(regexp_extract_all({content}, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}'),
                lambda m: NOT (ends_with(m, '@example.com') OR ends_with(m, '@users.noreply.github.com')))) > 0
        UNION ALL SELECT {key}, '{H.PHONE_ISSUE}' FROM {source}
            WHERE {public} AND regexp_matches({content}, '(?:^|[^0-9])(?:\+91[ -]?)?[6-9]\d{{4}}[ -]?\d{{5}}(?:[^0-9]|$)')
        UNION ALL SELECT {key}, '{H.SECRET_ISSUE}' FROM {source} WHERE regexp_matches({content}, '{H.SECRET}')"""


_TAGS = r"""WITH page AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)), ':\d*$', '') AS site,
        regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS path,
        regexp_replace(html, '(?is)<!--.*?-->|(<script\b[^>]*>).*?</script\s*>|(<style\b[^>]*>).*?</style\s*>', '\1\2', 'g') AS html FROM pages),
    tag AS (SELECT page_id, site, path, unnest(regexp_extract_all(html,
        '(?s)<[A-Za-z](?:[^>"'']|"[^"]*"|''[^'']*'')*>')) AS tag FROM page) """


def _attribute_sql(name: str) -> str:
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))"""
    return "(" + " || ".join(f"regexp_extract(tag, '{pattern}', {i})" for i in (1, 2, 3)) + ")"


ORACLE = {
    "contact_audit": _contact_sql("doc_id", "text", "documents"),
    "contact_audit_pages": _contact_sql("page_id", "html", "pages"),
    "contact_audit_chats": _contact_sql(
        "turn_id", "text",
        "(SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS turn_id, role, text FROM conversations) c",
        "role = 'user'",
    ),
    "images_without_alt": _TAGS + f"""SELECT page_id, count(*) AS images FROM tag
        WHERE regexp_matches(tag, '(?i)^<img[\\s/>]') AND {_attribute_sql('alt')} = '' GROUP BY page_id""",
    # the pages themselves have no images
    "images_without_alt_mixed": """SELECT page_id, CAST(CASE page_id % 4 WHEN 2 THEN 1 ELSE 2 END AS BIGINT) AS images
        FROM pages WHERE page_id % 4 IN (2, 3)""",
    "reference_audit": _TAGS + f""", ref AS (SELECT page_id, site, path, unnest([{_attribute_sql('src')}, {_attribute_sql('href')}]) AS r FROM tag),
        loc AS (SELECT page_id, site, path, url_decode(regexp_extract(r, '^[^?#]*', 0)) AS r FROM ref
            WHERE r <> '' AND NOT regexp_matches(r, '^[A-Za-z][A-Za-z0-9+.\\-]*:') AND NOT starts_with(r, '//')
                AND regexp_extract(r, '^[^?#]*', 0) <> ''),
        tgt AS (SELECT page_id, site, array_to_string(list_filter(string_split(CASE WHEN starts_with(r, '/') THEN r
            ELSE regexp_replace(path, '[^/]*$', '') || r END, '/'), lambda x: x <> '' AND x <> '.'), '/') AS target FROM loc),
        known AS (SELECT DISTINCT site, array_to_string(list_filter(string_split(path, '/'), lambda x: x <> ''), '/') AS target FROM page)
        SELECT page_id, target, count(*) AS "references" FROM tgt
        WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.site = tgt.site AND (k.target = tgt.target
            OR k.target = tgt.target || '/index.html')) GROUP BY page_id, target""",
}
