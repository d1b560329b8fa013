"""INR amounts as integer paise. Money never passes through a running double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockweave.functions.text import col, strip

# Accepted price texts (plain, western or Indian grouping) and bounds.
CURRENCY_PREFIX = r"(?i)\A(?:INR\s*|₹\s*)"
PRICE_TEXT = r"\A(?:\d+|\d{1,3}(?:,\d{3})+|\d{1,2}(?:,\d{2})*,\d{3})(?:\.\d{1,2})?\z"
MAX_PRICE_MINOR = 100_000_000
PRICE_FORMAT_PROBLEM = "price must be a positive INR amount with at most two decimal places"
PRICE_RANGE_PROBLEM = "price must be between INR 0.01 and INR 1000000.00"


def _bare(c) -> Column:
    return F.regexp_replace(strip(c), CURRENCY_PREFIX, "")


def price_text_to_paise(c) -> Column:
    """Catalog price text to paise; NULL when the text or the amount is invalid."""
    bare = _bare(c)
    amount = F.replace(bare, F.lit(","), F.lit("")).try_cast("decimal(38,2)") * 100
    paise = F.when(bare.rlike(PRICE_TEXT), amount)
    return F.when((paise > 0) & (paise <= MAX_PRICE_MINOR), paise.cast("bigint"))


def price_text_problem(c) -> Column:
    return F.when(~_bare(c).rlike(PRICE_TEXT), F.lit(PRICE_FORMAT_PROBLEM)).when(
        price_text_to_paise(c).isNull(), F.lit(PRICE_RANGE_PROBLEM)
    )


def amount_to_paise(text) -> Column:
    """Plain or exponent amount text to paise; NULL unless positive, capped, whole paise."""
    amount = strip(text).try_cast("decimal(38,30)")
    # split off the paise before scaling: decimal(38,30) * 100 would lose digits
    paise = F.round(amount, 2)
    return F.when(
        (amount > 0) & (amount <= MAX_PRICE_MINOR // 100) & (paise == amount),
        (paise.cast("decimal(20,2)") * 100).cast("bigint"),
    )


def rupees_to_paise(c) -> Column:
    """A DOUBLE column of rupees, row by row, before any sum."""
    return F.round(col(c) * 100).cast("bigint")
