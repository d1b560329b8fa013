"""Product ids, checkout keys and cart fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockweave.functions.text import blank_if_null, col, let, squash

# Id patterns and the source prefix.
CATALOG_ID = r"\A[a-z0-9]+(?:-[a-z0-9]+)*\z"
CART_PRODUCT_ID = r"\A[a-z0-9][a-z0-9-]{0,79}\z"
PLAIN_UUID = r"\A[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\z"
SOURCE_PREFIX = "source-"
MAX_SLUG = 72


def catalog_id(c) -> Column:
    return F.lower(squash(blank_if_null(c)))


def catalog_id_valid(c) -> Column:
    return col(c).rlike(CATALOG_ID) & F.length(col(c)).between(3, 64)


def stable_id(code) -> Column:
    """Slug of a source code; NULL when nothing usable is left."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(blank_if_null(code)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when((slug != "") & (F.length(slug) <= MAX_SLUG), F.concat(F.lit(SOURCE_PREFIX), slug))


def uuid_form(hex32: Column) -> Column:
    return F.concat_ws(
        "-",
        F.substring(hex32, 1, 8),
        F.substring(hex32, 9, 4),
        F.substring(hex32, 13, 4),
        F.substring(hex32, 17, 4),
        F.substring(hex32, 21, 12),
    )


def canonical_uuid(c) -> Column:
    """Lower-case hyphenated UUID of a 36-character key; NULL when it is none.

    A key that has its hyphens in place only needs lower case.
    """
    return F.when(col(c).rlike(PLAIN_UUID), F.lower(col(c))).otherwise(_any_uuid(c))


def _any_uuid(c) -> Column:
    bare = F.replace(F.replace(col(c), F.lit("urn:"), F.lit("")), F.lit("uuid:"), F.lit(""))
    digits = F.lower(F.translate(F.btrim(bare, F.lit("{}")), "-", ""))
    hex32 = (F.length(digits) == 32) & (F.translate(digits, "0123456789abcdef", "") == "")
    return let(F.when((F.length(col(c)) == 36) & hex32, digits), _hyphenate)


def _hyphenate(digits: Column) -> Column:
    return F.when(digits.isNotNull(), uuid_form(digits))


def _escape(char: Column) -> Column:
    code = F.ascii(char)
    unit = lambda n: F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(n), 4, "0")))
    offset = code - 0x10000
    pair = F.concat(
        unit(F.lit(0xD800) + F.shiftright(offset, 10)),
        unit(F.lit(0xDC00) + offset.bitwiseAND(0x3FF)),
    )
    return F.when(code < 127, char).when(code < 0x10000, unit(code)).otherwise(pair)


def ascii_json(text: Column) -> Column:
    """JSON text with everything beyond ASCII written as \\uXXXX."""
    escaped = F.array_join(F.transform(F.split(text, ""), _escape), "")
    return F.when(text.rlike(r"[^\x00-\x7e]"), escaped).otherwise(text)


def cart_json(lines) -> Column:
    """The sorted lines as compact JSON with sorted keys.

    `lines` is an array of structs with product_id, size, color and quantity.
    """
    ordered = F.transform(
        col(lines),
        lambda x: F.struct(
            x["color"].alias("color"),
            x["product_id"].alias("product_id"),
            x["quantity"].alias("quantity"),
            x["size"].alias("size"),
        ),
    )
    return F.to_json(ordered)


def fingerprint(json) -> Column:
    """SHA-256 of a JSON text in ASCII."""
    return F.sha2(ascii_json(col(json)), 256)


def cart_fingerprint(lines) -> Column:
    """The fingerprint of `cart_json`."""
    return fingerprint(cart_json(lines))
