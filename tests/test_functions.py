import random
import re

import pytest
from pyspark.sql import functions as F

from stockweave.functions import identity, money, text, urls


def values(spark, inputs, expression):
    rows = spark.createDataFrame(list(enumerate(inputs)), "i int, v string")
    return [r.x for r in rows.orderBy("i").select(expression("v").alias("x")).collect()]


def test_price_text(spark):
    good = {"0.01": 1, "19.99": 1999, "INR 1,23,456.78": 12345678, "₹1,000,000.00": 100000000, " inr5 ": 500}
    assert values(spark, good, money.price_text_to_paise) == list(good.values())
    bad = ["", "0", "-1", "NaN", "Infinity", "1e3", "1.005", "12,34", "1,000.001", "1000000.01", "1 USD", "1 299"]
    assert values(spark, bad, money.price_text_to_paise) == [None] * len(bad)
    assert None not in values(spark, bad, money.price_text_problem)


def test_amounts(spark):
    found = values(spark, ["12.5", "1e3", "1.005", "0", "NaN", "1000000", "1000000.01", "x", "9" * 40],
                   money.amount_to_paise)
    assert found == [1250, 100000, None, None, None, 100000000, None, None, None]


URLS = {
    "https://www.Shop.in:443/p/a/?utm_source=f&b=2&a=1&REF=x&ref_id=3#frag": "https://shop.in/p/a?a=1&b=2",
    "https://user:pw@x.com/a%20b?q=a%20b+c~*&q=": "https://x.com/a%20b?q=&q=a+b+c~%2A",
    "http://x.com": "http://x.com/",
    "": "/",
    " https://x.com/p;v=1/q;s=2 ": "https://x.com/p;v=1/q",
    "mailto:a": "mailto:a",
    "//h/p//": "//h/p",
    "https://x.com?a&b=&=c&&": "https://x.com/?=c&a=&b=",
    "https://x.com/?q=%zz": "https://x.com/?q=%25zz",
}


def test_url_keys(spark):
    assert values(spark, URLS, urls.url_key) == list(URLS.values())
    assert values(spark, [None], urls.url_key) == ["/"]
    checks = ["https://a.b/c", "http://a.b", "https:///x", "ftp://a", ""]
    assert values(spark, checks, urls.is_https) == [True, False, False, False, False]


def test_text_keys_and_labels(spark):
    assert values(spark, ["  a \t b\n", " x　"], text.squash) == ["a b", "x"]
    assert values(spark, ["Straße – No. 5!", None], text.text_key) == ["strasse no 5", ""]
    assert values(spark, [" S | M | m | L ", "", "ß|SS|a||A"], text.labels) == [["S", "M", "L"], [], ["ß", "a"]]
    assert values(spark, ["1", "YES", "False", "maybe"], text.flag) == [True, True, False, None]
    folded = values(spark, ["ÀB"], text.ascii_lower)
    assert folded == ["Àb"]


def test_runs_become_one_space_as_by_the_plain_patterns(spark):
    rng = random.Random(3)
    inputs = ["", " ", "a b", *["".join(rng.choices(" \t\u3000\x1cab-é", k=rng.randrange(9))) for _ in range(300)]]
    assert values(spark, inputs, text.squash) == [re.sub(f"[{text.SPACES}]+", " ", x).strip(" ") for x in inputs]
    assert values(spark, inputs, text.text_key) == [re.sub("[^a-z0-9]+", " ", x).strip(" ") for x in inputs]


def test_descriptions(spark):
    long = "A soft cotton shirt with a regular fit and long sleeves."
    check = lambda c: text.meaningful_description(c, F.lit(long + "!"))
    found = values(spark, ["short", long, "Category: all kinds of shirts that we sell online today", long + " More."], check)
    assert found == [False, False, False, True]


def test_ids(spark):
    assert values(spark, ["MEN-002", " --x__Y ", "--", "a" * 73], identity.stable_id) == [
        "source-men-002", "source-x-y", None, None]
    key = "0F0E0D0C-1111-2222-3333-444455556666"
    assert values(spark, [key, "x" * 36, "", key + "0", None], identity.canonical_uuid) == [
        key.lower(), None, None, None, None]


@pytest.mark.parametrize("raw, escaped", [("a", "a"), ("é", "\\u00e9"), ("😀", "\\ud83d\\ude00"), ("\x7f", "\\u007f")])
def test_ascii_json(spark, raw, escaped):
    assert values(spark, [raw], lambda c: identity.ascii_json(F.col(c))) == [escaped]
