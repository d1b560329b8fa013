import csv

import pytest
from pyspark.sql import functions as F

from stockweave.operators import cleaning as L
from stockweave.sources import sinks
from stockweave.sources.catalog_csv import header_issues, image_listing, read_catalog_csv, write_clean_catalog

FIELDS = ("id", "name", "category", "description", "price_inr", "image", "alt", "sizes", "colors", "featured")


def raw(number=1, **changes):
    """A row without fault or anything to normalise, and the given changes."""
    plain = (f"item-{number}", f"Item {number}", "kids", "Plain.", "10", "/assets/images/one.webp", "One", "", "", "0")
    return dict(zip(FIELDS, plain)) | changes


@pytest.fixture
def clean(spark, tmp_path):
    images = tmp_path / "images"
    images.mkdir()
    (images / "one.webp").write_bytes(b"image")
    (images / "OTHER.webp").write_bytes(b"image")
    source = tmp_path / "catalog.csv"

    def run(*rows, tail="", fields=FIELDS):
        with source.open("w", encoding="utf-8-sig", newline="") as stream:
            writer = csv.DictWriter(stream, fieldnames=fields)
            writer.writeheader()
            writer.writerows(rows)
            stream.write(tail)
        return L.clean_catalog(read_catalog_csv(spark, str(source)), image_listing(spark, str(images)))

    run.source = source
    return run


def issues(result):
    return {r.row: r.errors for r in L.issue_log(result).collect()}


NORMAL = [
    ("id", " ITEM-90", "item-90", "item-90"),
    ("name", "\tPaper   kite\u00a0", "Paper kite", "Paper kite"),
    ("category", "Men’s  clothing", "men", "men"),
    ("price_inr", "₹7,001.09", 700109, "700109"),
    ("image", "/assets/images/ONE.WEBP", "/assets/images/one.webp", "/assets/images/one.webp"),
    ("sizes", "35|36| 35 |", ["35", "36"], "35|36"),
    ("colors", "Sky|SKY|Sand", ["Sky", "Sand"], "Sky|Sand"),
    ("featured", "Yes", True, "1"),
]


@pytest.mark.parametrize(("field", "given", "stored", "logged"), NORMAL, ids=[n[0] for n in NORMAL])
def test_a_field_is_normalised_and_logged(clean, field, given, stored, logged):
    result = clean(raw(2), raw(3, **{field: given}))
    (product,) = [r for r in result.accepted.collect() if r.id != "item-2"]
    assert product["price_minor" if field == "price_inr" else field] == stored
    assert [(r.field, r.result) for r in result.normalizations.filter(F.col("row") == 3).collect() if r.field == field] == [(field, logged)]
    assert not [r for r in result.normalizations.collect() if r.field in ("description", "alt")]
    assert result.summary.collect()[0].status == "passed"


def test_every_row_of_a_repeated_id_is_rejected(clean):
    result = clean(raw(1), raw(2), raw(3), raw(id="Item-2 "), raw(5), raw(2, name="Other"))
    assert issues(result) == {n: [L.DUPLICATE_PROBLEM] for n in (3, 5, 7)}
    summary = result.summary.collect()[0]
    assert (summary.input_rows, summary.accepted_rows, summary.rejected_rows) == (6, 3, 3)


BAD = [
    ({"category": "appliances"}, L.CATEGORY_PROBLEM),
    ({"description": " "}, "description must contain 1-2000 characters"),
    ({"alt": ""}, "alt must contain 1-300 characters"),
    ({"name": ""}, "name must contain 1-120 characters"),
    ({"name": "x" * 121}, "name must contain 1-120 characters"),
    ({"featured": "maybe"}, L.FLAG_PROBLEM),
    ({"id": "bad_id"}, L.ID_PROBLEM),
    ({"image": "/assets/images/missing.webp"}, L.IMAGE_FILE_PROBLEM),
    ({"image": "/assets/images/other.webp"}, L.IMAGE_FILE_PROBLEM),
    ({"image": "https://example.com/one.webp"}, L.IMAGE_PATH_PROBLEM),
    ({"image": "/assets/images/../one.webp"}, L.IMAGE_PATH_PROBLEM),
    ({"image": "one.webp"}, L.IMAGE_PATH_PROBLEM),
    ({"sizes": "x" * 41}, "sizes contains an invalid option"),
    ({"colors": "|".join(f"c{i}" for i in range(21))}, "colors must contain at most 20 options"),
    ({"price_inr": "1000000.01"}, "price must be between INR 0.01 and INR 1000000.00"),
    ({"price_inr": "12,34"}, "price must be a positive INR amount with at most two decimal places"),
    ({"name": "Bad\x01value"}, "name " + L.CONTROL_PROBLEM),
    ({"alt": "Bad\x7fvalue"}, "alt " + L.CONTROL_PROBLEM),
    ({"description": "Bad\x00value"}, "description " + L.CONTROL_PROBLEM),
]


def test_each_rule_rejects_its_row(clean):
    rows = [raw(i, **change) for i, (change, _) in enumerate(BAD)]
    found = issues(clean(*rows))
    assert found == {i + 2: [problem] for i, (_, problem) in enumerate(BAD)}


def test_width_of_rows(clean):
    tail = "short-1,b\r\nlong-1,n,men,d,1,/assets/images/one.webp,a,,,0,extra\r\n"
    found = issues(clean(raw(), raw(2, description='a\n"quoted", line'), tail=tail))
    assert found[4][0] == L.WIDTH_PROBLEM and found[5] == [L.WIDTH_PROBLEM] and 3 not in found


def test_header_and_empty_catalog(spark, clean):
    result = clean()
    assert issues(result) == {1: [L.EMPTY_PROBLEM]} and result.summary.collect()[0].status == "failed"
    clean.source.write_text("id,name\n")
    assert header_issues(spark, str(clean.source)).collect()[0].error.startswith("missing columns: alt, category")
    clean.source.write_text(",".join(FIELDS) + ",id\n")
    assert header_issues(spark, str(clean.source)).collect()[0].error == "duplicate CSV column names"


def test_many_files_keep_their_own_row_numbers(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for n in range(3):
        lines = [",".join(FIELDS)] + [f"id-{n}-{i}" + "," * 9 for i in range(4)]
        (folder / f"{n}.csv").write_text("\n".join(lines) + "\n")
    rows = read_catalog_csv(spark, str(folder)).select("id", "row").collect()
    assert sorted((r.id, r.row) for r in rows) == [(f"id-{n}-{i}", i + 2) for n in range(3) for i in range(4)]


def test_failed_run_keeps_the_published_version(spark, clean, tmp_path):
    root = str(tmp_path / "published")
    good = clean(raw())
    assert sinks.publish_if_passed({"catalog": good.accepted}, good.summary, {"issues": L.issue_log(good)}, root)
    stored = sinks.read_published(spark, root, "catalog")
    assert sinks.drift(good.accepted, stored).count() == 0
    before = stored.collect()
    bad = clean(raw(price_inr="-1"))
    assert not sinks.publish_if_passed({"catalog": bad.accepted}, bad.summary, {"issues": L.issue_log(bad)}, root)
    assert sinks.read_published(spark, root, "catalog").collect() == before
    assert spark.read.json(f"{root}/report/summary").collect()[0].status == "failed"
    changed = clean(raw(price_inr="2", sizes="S|M", featured="no")).accepted
    assert {(r.side, r.price_minor, r.copies) for r in sinks.drift(changed, stored).collect()} == {
        ("missing", 200, 1), ("stale", 1000, 1)}
    assert sinks.publish(spark, {"catalog": changed}, root) == 2
    write_clean_catalog(changed, str(tmp_path / "clean"))
    text = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "clean" / "csv")).collect()[0]
    assert (text.sizes, text.featured, text.price_minor) == ('["S","M"]', "0", "200")
