"""Pages of a clustered listing against the sorted search."""

import re

import pytest
from pyspark.sql import functions as F

from stockweave.operators import catalog as C
from stockweave.operators import listing
from stockweave.operators.errors import RequestError


@pytest.fixture(scope="module")
def catalog(spark):
    """4,000 products, a third of them in one category at one price and with one name; some without price, name or flag."""
    n = F.col("id")
    rows = spark.range(4000).select(
        n,
        F.when(n % 3 == 0, "men").when(n % 3 == 1, "kids").otherwise("women").alias("category"),
        F.when(n % 3 == 0, F.lit(500)).when(n % 11 == 0, None).otherwise(n % 700).cast("bigint").alias("price_minor"),
        F.when(n % 3 == 0, F.lit("Same")).when(n % 13 == 0, None).otherwise(F.concat(F.lit("n"), n % 50)).alias("name"),
        F.when(n % 17 == 0, None).otherwise(n % 4 == 0).alias("featured"),
        F.concat(F.lit("Brand"), n % 5).alias("brand"),
    )
    return rows.withColumns({"description": F.lit(None).cast("string"), "source_store": F.lit("s"), "_extra": F.lit(1)})


@pytest.fixture(scope="module")
def stored(spark, catalog, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("listing"))
    assert listing.write_listing(catalog, root, files=40) == 1
    return listing.Listing(spark, root)


@pytest.mark.parametrize("sort", ["featured", "price_asc", "price_desc", "name"])
def test_pages_follow_the_sort(stored, catalog, sort):
    for wanted, size in (({"category": "men"}, 30), ({"q": "rand3", "min_price": "100", "max_price": "600"}, 200)):
        expected = [r.id for r in C.sort_catalog(C.search_catalog(catalog, **wanted), sort).limit(size * 2).collect()]
        found, after = [], None
        for _ in range(2):
            page = stored.page(sort, size, after, **wanted).collect()
            found, after = found + [r.id for r in page], page[-1].cursor
        assert found == expected


def test_last_page_and_beyond(stored, catalog):
    few = {"q": "brand2", "category": "kids", "max_price": "60"}
    expected = [r.id for r in C.sort_catalog(C.search_catalog(catalog, **few), "name").collect()]
    page = stored.page("name", 1000, **few).collect()
    assert [r.id for r in page] == expected and 0 < len(page) < 1000
    assert stored.page("name", 10, page[-1].cursor, **few).count() == 0
    assert stored.page("name", 10, q="no such text").count() == 0


def test_a_page_reads_a_small_share_of_the_rows(stored, catalog):
    after = stored.page("price_asc", 20, category="men").collect()[-1].cursor
    for page, share in ((stored.page("price_asc", 20, after, "men"), 0.06), (stored.page("price_desc", 20), 0.2)):
        files = page.inputFiles()
        assert files and stored.spark.read.parquet(*files).count() < share * catalog.count()
    text = stored.page("price_asc", 20, after, "men")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text and "GreaterThanOrEqual(_first,500)" in text and "Exchange rangepartitioning" not in text


def test_band_is_pushed_down(stored, catalog):
    found = stored.band("kids", min_price="100", max_price="120")
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in C.search_catalog(catalog, "kids", "", "100", "120").collect())
    text = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*category", text) and "GreaterThanOrEqual(price_minor,100), LessThanOrEqual(price_minor,120)" in text


def test_arguments_and_empty_listing(spark, stored, catalog, tmp_path):
    for wrong in ({"sort": "no"}, {"size": 0}, {"after": "x"}, {"category": "no"}, {"min_price": "9", "max_price": "1"}):
        with pytest.raises(RequestError):
            stored.page(**wrong)
    with pytest.raises(FileNotFoundError):
        listing.Listing(spark, str(tmp_path / "none"))
    root = str(tmp_path / "empty")
    listing.write_listing(catalog.limit(0), root, ("name",), files=4)
    empty = listing.Listing(spark, root)
    assert empty.page("name").count() == 0
    with pytest.raises(RequestError):
        empty.page("featured")
