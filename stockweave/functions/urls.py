"""URL parts and the tracking-free key two listings of one product share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockweave.functions.text import blank_if_null, let, strip

# Query keys that never identify a product, and allowed image hosts.
TRACKING_KEYS = ("gclid", "fbclid", "mc_cid", "mc_eid", "ref", "tag", "linkcode", "srsltid")
TRACKING_PREFIXES = ("utm_", "ref_")
_TRACKING = rf"\A(?:{'|'.join(TRACKING_PREFIXES)}|(?:{'|'.join(TRACKING_KEYS)})\z)"
IMAGE_HOSTS = (
    "cdn.fcglcdn.com",
    "cdn.shopify.com",
    "cdn2.clevup.in",
    "images-eu.ssl-images-amazon.com",
    "indigodreams.in",
    "m.media-amazon.com",
    "mymilestones.in",
    "rukmini1.flixcart.com",
    "rukminim2.flixcart.com",
    "sreeleathersonline.com",
    "sunglassescraft.com",
    "uspoloassn.in",
    "walkwayshoes.com",
    "www.9shineslabel.com",
    "www.beloreslims.com",
    "www.montecarlo.in",
)

# The generic URI pattern of RFC 3986, appendix B: 1 scheme, 2 authority, 3 path, 4 query.
URI = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
# Visible ASCII: nothing to strip and nothing to drop.
_CLEAN = r"\A[!-~]*\z"
_MARK = "\u0001"
SCHEME, AUTHORITY, PATH, QUERY = range(4)


def _split(c) -> Column:
    """Scheme, authority, path and query in one pass over the URL."""

    def parts(url: Column) -> Column:
        cleaned = F.translate(strip(url), "\t\r\n" + _MARK, "")
        plain = F.when(url.rlike(_CLEAN), url).otherwise(cleaned)
        return F.split(F.regexp_replace(plain, URI, _MARK.join(("$1", "$2", "$3", "$4"))), _MARK)

    return let(blank_if_null(c), parts)


def _host(authority: Column) -> Column:
    return F.lower(F.regexp_replace(F.substring_index(authority, "@", -1), r":[^:\]]*$", ""))


def scheme(c) -> Column:
    return F.lower(_split(c)[SCHEME])


def host(c) -> Column:
    """Lower-case host without user info and port; empty when there is none."""
    return _host(_split(c)[AUTHORITY])


def path(c) -> Column:
    return _split(c)[PATH]


def is_https(c) -> Column:
    """TRUE for an absolute https URL with a host."""
    return let(_split(c), lambda u: (F.lower(u[SCHEME]) == "https") & (_host(u[AUTHORITY]) != ""))


def is_https_on(c, hosts: tuple[str, ...]) -> Column:
    """TRUE for an https URL on one of the hosts."""
    return let(_split(c), lambda u: (F.lower(u[SCHEME]) == "https") & _host(u[AUTHORITY]).isin(*hosts))


def _decode(text: Column) -> Column:
    decoded = F.coalesce(F.try_url_decode(text), F.replace(text, F.lit("+"), F.lit(" ")))
    return F.when(text.rlike("[%+]"), decoded).otherwise(text)


def _encode(text: Column) -> Column:
    encoded = F.replace(F.url_encode(text), F.lit("%7E"), F.lit("~"))
    return F.when(text.rlike("[^A-Za-z0-9._-]"), F.replace(encoded, F.lit("*"), F.lit("%2A"))).otherwise(text)


def _is_tracking(key: Column) -> Column:
    return F.lower(key).rlike(_TRACKING)


def _query_pair(text: Column) -> Column:
    cut = F.instr(text, "=")
    return F.struct(
        _decode(F.when(cut > 0, F.substring_index(text, "=", 1)).otherwise(text)).alias("key"),
        _decode(F.when(cut > 0, F.substr(text, cut + 1)).otherwise(F.lit(""))).alias("value"),
    )


def _query(text: Column) -> Column:
    pairs = F.transform(F.filter(F.split(text, "&"), lambda x: x != ""), _query_pair)
    kept = F.array_sort(F.filter(pairs, lambda p: ~_is_tracking(p["key"])))
    pair = lambda p: F.concat(_encode(p["key"]), F.lit("="), _encode(p["value"]))
    joined = F.array_join(F.transform(kept, pair), "&")
    return F.when(text == "", F.lit("")).otherwise(
        let(joined, lambda q: F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))
    )


def _join(scheme: Column, host: Column, path: Column, query: Column) -> Column:
    name = F.when(host.startswith("www."), F.substr(host, F.lit(5))).otherwise(host)
    mark = F.when((host != "") | scheme.isin("http", "https"), F.lit("//")).otherwise("")
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        mark,
        name,
        F.when(path == "", F.lit("/")).otherwise(path),
        query,
    )


def _key(u: Column) -> Column:
    # `;parameters` of the last path segment and trailing slashes do not count
    bare = F.when(F.contains(u[PATH], F.lit(";")), F.regexp_replace(u[PATH], r";[^/]*$", "")).otherwise(u[PATH])
    parts = F.array(F.lower(u[SCHEME]), _host(u[AUTHORITY]), F.rtrim(bare, F.lit("/")), _query(u[QUERY]))
    return let(parts, lambda p: _join(p[0], p[1], p[2], p[3]))


def url_key(c) -> Column:
    """Same product page, same key.

    Scheme and host in lower case, no `www.`, port, fragment, trailing slash or
    tracking parameter; what is left of the query is sorted and re-encoded.
    """
    return let(_split(c), _key)
