"""Whitespace, case folding, labels and description checks."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace and control classes of the catalog rules.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# Runs of whitespace, and of what is no letter or digit, that are not one plain space already.
_RUNS = f"[{SPACES.replace(' ', '')}][{SPACES}]*| [{SPACES}]+"
_OTHER_RUNS = "[^a-z0-9 ][^a-z0-9]*| [^a-z0-9]+"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
CONTROL_IN_LABEL = r"[\x00-\x1f]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Phrases that do not count as a product description.
GENERIC_PHRASES = (
    "no description available",
    "description not available",
    "product details unavailable",
    "shop now",
    "best price online",
    "buy online",
    "category",
)
MIN_DESCRIPTION = 40


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_if_null(c) -> Column:
    return F.coalesce(col(c), F.lit(""))


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def present(*texts: Column) -> Column:
    """Array of the texts that are not NULL, each once, in order.

    Unlike a lambda over the array, this keeps the texts inside generated code.
    """
    return F.array_except(F.array(*texts), F.array(F.lit(None).cast("string")))


def strip(c) -> Column:
    """Whitespace off both ends, inner runs untouched."""
    return F.btrim(col(c), F.lit(SPACES))


def squash(c) -> Column:
    """Runs of whitespace become one space; none at either end."""
    return F.trim(F.regexp_replace(col(c), _RUNS, " "))


def ascii_lower(c) -> Column:
    """Fold A-Z only, so order and matching equal an ASCII NOCASE collation."""
    return F.translate(col(c), UPPER, UPPER.lower())


def fold(c) -> Column:
    """Case folding; sharp s is the one expansion retailers actually send."""
    return F.replace(F.lower(col(c)), F.lit("ß"), F.lit("ss"))


def text_key(c) -> Column:
    """Folded text with every run of other characters as one space."""
    return F.trim(F.regexp_replace(fold(blank_if_null(c)), _OTHER_RUNS, " "))


def contains_literal(c, needle: str) -> Column:
    """ASCII-case-insensitive substring test; wildcards have no meaning."""
    return F.contains(ascii_lower(blank_if_null(c)), ascii_lower(F.lit(needle)))


def meaningful_description(description, title) -> Column:
    def judge(x: Column) -> Column:
        generic = F.lit(False)
        for phrase in GENERIC_PHRASES:
            generic = generic | (x["key"] == phrase) | x["key"].startswith(phrase + " ")
        return (F.length(x["text"]) >= MIN_DESCRIPTION) & (x["key"] != "") & (x["key"] != x["title"]) & ~generic

    def keyed(x: Column) -> Column:
        return let(F.struct(x.alias("text"), text_key(x).alias("key"), text_key(title).alias("title")), judge)

    return let(squash(blank_if_null(description)), keyed)


def _distinct_labels(parts: Column) -> Column:
    folded = F.transform(parts, fold)
    return let(folded, lambda f: F.filter(parts, lambda x, i: F.array_position(f, fold(x)) == i + 1))


def labels(c) -> Column:
    """Pipe-separated labels: trimmed, empties dropped, first of each case kept."""
    parts = F.filter(F.transform(F.split(blank_if_null(c), r"\|"), squash), lambda x: x != "")
    return let(parts, _distinct_labels)


def labels_problem(c, parsed, field: str, max_length: int = 40, max_items: int = 20) -> Column:
    """Message for an invalid label list, NULL when it is fine; `parsed` are its labels."""

    def bad(part: Column) -> Column:
        return let(squash(part), lambda x: (F.length(x) > max_length) | (x.rlike(CONTROL_IN_LABEL) & (x != "")))

    return F.when(F.exists(F.split(blank_if_null(c), r"\|"), bad), F.lit(f"{field} contains an invalid option")).when(
        F.size(col(parsed)) > max_items, F.lit(f"{field} must contain at most {max_items} options")
    )


def flag(c) -> Column:
    """0/1, true/false, yes/no as a boolean; NULL for anything else."""
    text = F.lower(col(c))
    return F.when(text.isin("1", "true", "yes"), True).when(text.isin("0", "false", "no"), False)


# A character reference, a lone ampersand, or a stretch without any.
_REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?|&|[^&]+"
_REPLACEMENT = "\ufffd"


def _code_point(code: Column) -> Column:
    """The character of a number; numbers that are no character give U+FFFD, 128 to 159 mean Windows-1252."""
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    bad = code.isNull() | (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    out = F.when(bad, F.lit(_REPLACEMENT))
    for number in range(0x80, 0xA0):
        try:
            out = out.when(code == number, F.lit(bytes([number]).decode("cp1252")))
        except UnicodeDecodeError:
            continue
    return out.otherwise(plain)


def unescape(c: Column) -> Column:
    """HTML character references as the characters they stand for, in any value that has an ampersand."""
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")

    def decoded(part: Column) -> Column:
        sixteen = F.regexp_extract(part, r"^&#[xX]0*([0-9a-fA-F]*)", 1)
        ten = F.regexp_extract(part, r"^&#0*([0-9]*)", 1)
        # more digits than any code point has are no character
        code = F.when(part.rlike("^&#[xX]"), F.when(F.length(sixteen) <= 8, F.conv(sixteen, 16, 10).cast("long")))
        code = code.otherwise(F.when(F.length(ten) <= 9, F.concat(F.lit("0"), ten).cast("long")))
        named = F.coalesce(F.try_element_at(names, F.substr(part, F.lit(2))), part)
        return F.when(part.startswith("&#") & (F.length(part) > 2), _code_point(code)).when(part.startswith("&"), named).otherwise(part)

    parts = F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0))
    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(parts, decoded), "")).otherwise(c)
