"""Audits of text and HTML: contact data, credentials, references, alt texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.functions import urls
from stockweave.functions.text import present, unescape

# Patterns of the audit and the demo mail domains.
EMAIL = r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"
PHONE = r"(?<!\d)(?:\+91[ -]?)?[6-9]\d{4}[ -]?\d{5}(?!\d)"
SECRET = (
    r"(?:gh[pousr]_[A-Za-z0-9]{30,}|github_pat_[A-Za-z0-9_]{30,}"
    r"|-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----)"
)
DEMO_MAIL = ("@example.com", "@users.noreply.github.com")
EMAIL_ISSUE = "Non-demo email address found"
PHONE_ISSUE = "Possible real phone number found"
SECRET_ISSUE = "Possible credential found"

# Start tags with their attributes; comments and script or style bodies are no tags. A comment, body,
# tag or quote that is never closed takes the rest of the page with it, so a page is read once.
INVISIBLE = (
    r"(?is)<!--.*?(?:-->|\z)|(<(?:script|style)\b[^>]*+(?:>|\z)).*?(?:</(?:script|style)(?=\s*+>)\s*+>|\z)"
)
# Possessive runs: a tag of any length is matched without a stack frame per character.
TAG = r"""(?s)(<[A-Za-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>)|<[A-Za-z].*+"""
# A name with its value, read one after the other, so that no value is taken for a name.
PAIR = r"""(?s)[\s/]++([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"']++))?+"""
INDEX = "index.html"


def contact_audit(docs: DataFrame, key: str, content: str = "text", public: Column | None = None) -> DataFrame:
    """One row per document and kind of finding, over whole texts.

    The mail pattern only runs where there is an @ at all.

    Phone numbers only count in public-facing documents (`public`, default all).
    """
    mails = F.regexp_extract_all(content, F.lit(EMAIL), F.lit(0))
    foreign = F.contains(F.col(content), F.lit("@")) & F.exists(
        mails, lambda m: ~(m.endswith(DEMO_MAIL[0]) | m.endswith(DEMO_MAIL[1]))
    )
    shown = F.lit(True) if public is None else public
    issues = present(
        F.when(foreign, F.lit(EMAIL_ISSUE)),
        F.when(shown & F.col(content).rlike(PHONE), F.lit(PHONE_ISSUE)),
        F.when(F.col(content).rlike(SECRET), F.lit(SECRET_ISSUE)),
    )
    return docs.select(key, F.explode(issues).alias("issue"))


def tags(html) -> Column:
    """Start tags of a page as text."""
    visible = F.regexp_replace(html, INVISIBLE, "$1")
    return F.filter(F.regexp_extract_all(visible, F.lit(TAG), F.lit(1)), lambda t: t != "")


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, empty when it is absent or has none; the last of equal names counts."""
    names, values = [F.regexp_extract_all(tag, F.lit(PAIR), F.lit(i)) for i in (1, 2)]
    pairs = F.zip_with(names, values, lambda n, v: F.struct(F.lower(n).alias("name"), v.alias("value")))
    own = F.filter(pairs, lambda p: p["name"] == name)
    raw = F.coalesce(F.try_element_at(own, F.lit(-1))["value"], F.lit(""))
    quoted = F.substring(raw, 1, 1).isin('"', "'")
    return unescape(F.when(quoted, F.substr(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw))


def images_without_alt(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Number of images without a text, pages that have any."""
    bare = F.filter(tags(html), lambda t: t.rlike(r"(?i)\A<img[\s/>]") & (attribute(t, "alt") == ""))
    return pages.select(key, F.size(bare).cast("bigint").alias("images")).filter("images > 0")


def _normal_path(path: Column) -> Column:
    """Lexical path: empty and `.` segments go, `..` removes the segment before it."""

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(part == "..", up).otherwise(F.concat(done, F.array(part)))

    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    return F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")


def page_references(pages: DataFrame, key: str, path: str, html: str = "html", site: str | None = None) -> DataFrame:
    """Local references of each page: (page, reference, target path without leading slash)."""
    keys = [key, *([site] if site else [])]
    refs = F.flatten(F.transform(tags(html), lambda t: F.array(attribute(t, "src"), attribute(t, "href"))))
    found = pages.select(*keys, F.col(path).alias("_page"), F.explode(refs).alias("reference"))
    found = found.filter(F.col("reference") != "")
    local = (urls.scheme("reference") == "") & (urls.host("reference") == "") & (urls.path("reference") != "")
    found = found.filter(local)
    plain = F.coalesce(F.try_url_decode(F.replace(urls.path("reference"), F.lit("+"), F.lit("%2B"))), urls.path("reference"))
    folder = F.regexp_replace("_page", r"[^/]*\z", "")
    target = F.when(plain.startswith("/"), plain).otherwise(F.concat(folder, plain))
    return found.select(*keys, "reference", _normal_path(target).alias("target"))


def known_targets(paths: DataFrame, path: str, site: str | None = None) -> DataFrame:
    """Existing paths, and for an index page its folder as well."""
    normal = _normal_path(F.col(path))
    folder = F.when(normal == INDEX, F.lit("")).when(
        normal.endswith("/" + INDEX), F.regexp_replace(normal, "/" + INDEX.replace(".", r"\.") + r"\z", "")
    )
    both = F.filter(F.array(normal, folder), lambda p: p.isNotNull())
    return paths.select(*([site] if site else []), F.explode(both).alias("target")).distinct()


def reference_audit(
    pages: DataFrame, known: DataFrame, key: str, path: str, html: str = "html", site: str | None = None
) -> DataFrame:
    """References whose target does not exist. The anti join has many references per
    target on its left side only, the side AQE may split."""
    refs = page_references(pages, key, path, html, site)
    on = [*([site] if site else []), "target"]
    return refs.join(known_targets(known, path, site), on, "left_anti").select(key, "reference", "target")
