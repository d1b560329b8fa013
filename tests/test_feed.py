import copy
import json
import random

import pytest
from pyspark.sql import functions as F

from stockweave.operators import feed as M
from stockweave.schemas import IMAGE_EVIDENCE, LEDGER, PAGE_EVIDENCE
from stockweave.sources.feeds import read_evidence, read_feed, read_feed_lines, read_ledger, write_ledger

ITEM = {
    "id": "MEN-2",
    "title": "Regular  Fit Shirt",
    "category": "Men",
    "currency": "INR",
    "price_inr": 485,
    "mrp_inr": 999.5,
    "discount_percent": 51,
    "description": "A checked shirt in soft cotton with a regular fit and a spread collar.",
    "color": "Grey checks",
    "sizes": ["39", "40"],
    "brand": "Acorn",
    "subcategory": "Shirts",
    "material": "Cotton",
    "fit": None,
    "rating": {"value": 4.1, "scale": 5, "count": 20},
    "source_product_id": "SKU1",
    "source_store": "Shop  One",
    "canonical_url": "https://www.shop.example/p/1",
    "image_urls": ["https://cdn.shopify.com/a.jpg"],
}
PAGE = {
    "id": "MEN-2",
    "status": "accessible",
    "http_status": 200,
    "source_url": "https://www.shop.example/p/1",
    "identity_match": True,
    "verified_fields": ["price", "image", "description", "color", "sizes", "brand", "material", "rating"],
    "restored_fields": ["mrp_inr"],
}
IMAGE = {
    "product_id": "MEN-2",
    "source_url": "https://www.shop.example/p/1",
    "image_url": "https://cdn.shopify.com/a.jpg",
    "status": "verified",
    "http_status": 200,
    "content_type": "image/jpeg; q=1",
    "https": True,
    "identity_match": True,
    "source_image_verified": True,
    "rendered": True,
    "csp_allowed": True,
}


def feed_of(spark, items):
    rows = [(i, json.dumps(item)) for i, item in enumerate(items)]
    return spark.createDataFrame(rows, "pos bigint, text string").select("pos", F.parse_json("text").alias("item"))


def evidence(spark, rows, schema):
    return spark.createDataFrame([tuple(r.get(f) for f in schema.fieldNames()) for r in rows], schema)


def run(spark, items, pages, images, base=None):
    base = base if base is not None else spark.createDataFrame([], LEDGER).withColumn("origin", F.lit(0))
    return M.classify_feed(
        feed_of(spark, items), evidence(spark, pages, PAGE_EVIDENCE), evidence(spark, images, IMAGE_EVIDENCE), base
    )


def variant(n, item=None, page=None, image=None):
    """A further good product with its own code, URL and SKU, and changes on top."""
    code, url = f"MEN-{n}", f"https://www.shop.example/p/{n}"
    return (
        {**copy.deepcopy(ITEM), "id": code, "canonical_url": url, "source_product_id": f"SKU{n}",
         "title": f"Shirt {n}", **(item or {})},
        {**PAGE, "id": code, "source_url": url, **(page or {})},
        {**IMAGE, "product_id": code, "source_url": url, **(image or {})},
    )


def test_complete_product_is_accepted_and_mapped(spark):
    result = run(spark, [ITEM], [PAGE], [IMAGE])
    row = result.results.collect()[0]
    assert (row.status, row.product_id, row.failure_reasons) == ("ACCEPTED", "source-men-2", [])
    assert row.validation.not_duplicate and row.validation.verified_detail_fields == [
        "description", "material", "color", "sizes"]
    product = result.accepted.collect()[0]
    assert (product.price_minor, product.mrp_minor, product.discount_percent) == (48500, 99950, None)
    assert (product.colors, product.sizes, product.brand) == (["Grey checks"], ["39", "40"], "Acorn")
    assert (product.rating_value, product.rating_scale, product.rating_count) == (4.1, 5.0, 20)
    assert product.missing_fields == ["subcategory", "mrp_inr", "discount_percent", "fit"]
    assert (product.source_store, product.alt) == ("Shop One", "Regular Fit Shirt product image")


NO_DETAILS = {"description": None, "material": None, "fit": None, "color": None, "sizes": None, "subcategory": None}
CASES = [
    ({"image_urls": []}, {}, {"status": None}, "IMAGE_MISSING", ["IMAGE_MISSING"]),
    ({}, {}, {"status": "rejected", "http_status": 404, "content_type": "text/html"}, "IMAGE_BROKEN", ["IMAGE_BROKEN"]),
    ({"image_urls": ["https://evil.example/a.jpg"]}, {}, {}, "IMAGE_BROKEN", ["IMAGE_BROKEN"]),
    ({"price_inr": None}, {"verified_fields": ["image", "description"]}, {}, "PRICE_MISSING",
     ["PRICE_MISSING", "PRICE_UNVERIFIED"]),
    ({"price_inr": 1.005}, {}, {}, "PRICE_INVALID", ["PRICE_INVALID", "PRICE_MISSING"]),
    ({"price_inr": True}, {}, {}, "PRICE_INVALID", ["PRICE_INVALID", "PRICE_MISSING"]),
    ({"price_inr": "1e3"}, {}, {}, None, []),
    ({"mrp_inr": [1]}, {}, {}, "PRICE_INVALID", ["PRICE_INVALID"]),
    (NO_DETAILS, {"verified_fields": ["image", "price"]}, {}, "DESCRIPTION_MISSING", ["DESCRIPTION_MISSING"]),
    ({}, {"verified_fields": ["image", "price"]}, {}, "DETAILS_INSUFFICIENT", ["DETAILS_INSUFFICIENT"]),
    ({}, {"status": "inaccessible", "http_status": None, "identity_match": False}, {}, "SOURCE_INACCESSIBLE",
     ["SOURCE_INACCESSIBLE"]),
    ({}, {"status": "redirected_mismatch", "identity_match": False}, {}, "REDIRECTED_TO_DIFFERENT_PRODUCT",
     ["REDIRECTED_TO_DIFFERENT_PRODUCT"]),
    ({}, {"http_status": 404}, {}, "SOURCE_INACCESSIBLE", ["SOURCE_INACCESSIBLE"]),
    ({}, {"identity_match": False}, {}, "PRODUCT_MISMATCH", ["PRODUCT_MISMATCH"]),
    ({"canonical_url": "http://www.shop.example/p/9"}, {}, {}, "SOURCE_URL_INVALID",
     ["SOURCE_URL_INVALID", "IMAGE_BROKEN"]),
    ({"category": "toys", "currency": "USD"}, {}, {}, "INVALID_CATEGORY", ["INVALID_CATEGORY", "PRICE_INVALID"]),
    ({"discount_percent": 10.0}, {}, {}, "VALIDATION_FAILED", ["VALIDATION_FAILED"]),
    ({"discount_percent": 101}, {}, {}, "VALIDATION_FAILED", ["VALIDATION_FAILED"]),
    ({"sizes": ["S", 4]}, {}, {}, "VALIDATION_FAILED", ["VALIDATION_FAILED"]),
    ({"sizes": "S"}, {}, {}, "VALIDATION_FAILED", ["VALIDATION_FAILED"]),
    ({"color": 5}, {}, {}, "VALIDATION_FAILED", ["VALIDATION_FAILED"]),
    ({"rating": [5]}, {}, {}, "VALIDATION_FAILED", ["VALIDATION_FAILED"]),
    ({"source_store": " "}, {}, {}, "VALIDATION_FAILED", ["VALIDATION_FAILED"]),
    ({"title": ""}, {}, {}, "VALIDATION_FAILED", ["VALIDATION_FAILED"]),
]


def test_reason_codes(spark):
    rows = [variant(i, item, page, image) for i, (item, page, image, _, _) in enumerate(CASES)]
    items, pages, images = map(list, zip(*rows))
    found = {r.pos: r for r in run(spark, items, pages, images).results.collect()}
    for i, (_, _, _, first, reasons) in enumerate(CASES):
        assert (i, found[i].failure_reason, found[i].failure_reasons) == (i, first, reasons)
        assert found[i].status == ("REJECTED" if reasons else "ACCEPTED")


def test_entries_that_are_no_objects_or_have_no_id_are_rejected(spark):
    found = run(spark, [5, None, {**ITEM, "id": "--"}], [{**PAGE, "id": "--"}], [{**IMAGE, "product_id": "--"}])
    rows = {r.pos: r for r in found.results.collect()}
    assert [rows[i].status for i in range(3)] == ["REJECTED"] * 3
    assert rows[0].action_taken == M.NOT_AN_OBJECT and rows[0].failure_reasons == ["VALIDATION_FAILED"]
    assert rows[2].failure_reasons == ["VALIDATION_FAILED"]


def test_tracking_url_is_duplicate_and_second_run_is_existing(spark):
    twin = {**ITEM, "id": "MEN-2-DUPLICATE", "canonical_url": ITEM["canonical_url"] + "?utm_source=feed"}
    pages = [PAGE, {**PAGE, "id": twin["id"], "source_url": twin["canonical_url"]}]
    images = [IMAGE, {**IMAGE, "product_id": twin["id"], "source_url": twin["canonical_url"]}]
    first = run(spark, [ITEM, twin], pages, images)
    rows = {r.pos: r for r in first.results.collect()}
    assert rows[1].status == "DUPLICATE" and rows[1].duplicate_of == "source-men-2"
    assert rows[1].failure_reasons == ["DUPLICATE_PRODUCT"]
    assert rows[1].duplicate_reason == M.DUPLICATE_REASONS[M.URL]
    ledger = first.accepted.drop("pos").withColumn("origin", F.lit(1))
    again = run(spark, [ITEM], [PAGE], [IMAGE], ledger).results.collect()[0]
    assert again.status == "EXISTING" and again.duplicate_of == "source-men-2"
    summary = M.import_summary(first.results).collect()[0]
    assert (summary.urls_received, summary.successfully_added, summary.duplicates) == (2, 1, 1)
    breakdown = {r.reason: r.occurrences for r in M.failure_breakdown(first.results).collect()}
    assert breakdown == {"DUPLICATE_PRODUCT": 1}


def sequential(rows, existing):
    """First-wins fold over the feed, one row after the other."""
    seen, out = {}, []
    for pos, valid, own, asked, registered in rows:
        owner = next((seen[k] for k in asked if k in seen), None)
        if owner is None:
            owner = next((e for e, keys in existing if keys & set(asked)), None)
        if owner is not None:
            status = "EXISTING" if owner == own and own in [e for e, _ in existing] else "DUPLICATE"
        else:
            status = "ACCEPTED" if valid else "REJECTED"
        if status != "REJECTED":
            for k in registered:
                seen.setdefault(k, own)
        out.append((pos, status, owner))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_dedupe_equals_sequential_first_wins(spark, seed):
    rng = random.Random(seed)
    rows, n = [], 120
    for pos in range(n):
        keys = [(rule, f"{rule}-{rng.randrange(40)}") for rule in (M.URL, M.IDENTITY, M.PRODUCT)]
        asked = [k for k in keys if rng.random() < 0.7]
        registered = [k for k in keys if rng.random() < 0.8]
        rows.append((pos, rng.random() < 0.15, f"id-{rng.randrange(n)}", asked, registered))
    existing = [(f"id-{i}", {(M.URL, f"1-{rng.randrange(60)}")}) for i in sorted(rng.sample(range(n), 3), key=str)]
    keyed = "array<struct<rule:int,key:string>>"
    frame = spark.createDataFrame(
        [(p, o, [] if v else ["X"], [*a, (M.OWN_ID, o)], r) for p, v, o, a, r in rows],
        f"pos bigint, product_id string, reasons array<string>, asked {keyed}, registered {keyed}",
    )
    prefix = "https://"
    base = spark.createDataFrame([(e, f"{prefix}{list(k)[0][1]}/") for e, k in existing], "id string, canonical_url string")
    # the base keys are URL keys; ask for them in the same form
    form = lambda c: F.transform(
        c, lambda k: F.struct(k["rule"].alias("rule"),
                              F.when(k["rule"] == M.URL, F.concat(F.lit(prefix), k["key"], F.lit("/"))).otherwise(k["key"]).alias("key")))
    frame = frame.withColumn("asked", form("asked")).withColumn("registered", form("registered"))
    found = M.dedupe_feed(frame, base.withColumn("origin", F.lit(0)))
    got = {r.pos: r for r in found.collect()}
    for pos, status, owner in sequential(rows, existing):
        r = got.get(pos)
        mine = None
        if r is not None:
            mine = r.in_feed.owner.product_id if r.in_feed else (r.match.first.id if r.match else None)
        assert (pos, mine) == (pos, owner)


def test_readers(spark, tmp_path):
    doc = tmp_path / "feed.json"
    doc.write_text(json.dumps({"catalog_metadata": {"checked_on": "2026-01-01"}, "products": [ITEM, 3]}))
    assert [r.pos for r in read_feed(spark, str(doc)).orderBy("pos").collect()] == [0, 1]
    doc.write_text('{"products": {}}')
    with pytest.raises(ValueError):
        read_feed(spark, str(doc))
    lines = tmp_path / "lines"
    lines.mkdir()
    for part in range(3):
        (lines / f"p{part}.jsonl").write_text("\n".join(json.dumps({"id": f"{part}-{i}"}) for i in range(5)))
    rows = read_feed_lines(spark, str(lines)).selectExpr("pos", "variant_get(item, '$.id', 'string') id").orderBy("pos")
    assert [(r.pos, r.id) for r in rows.collect()] == [(5 * p + i, f"{p}-{i}") for p in range(3) for i in range(5)]
    checks = tmp_path / "pages.json"
    checks.write_text(json.dumps({"checks": [PAGE, {**PAGE, "status": "blocked"}]}))
    assert [r.status for r in read_evidence(spark, str(checks), "id", PAGE_EVIDENCE).collect()] == ["blocked"]
    assert read_ledger(spark, str(tmp_path / "none.json")).count() == 0
    assert read_ledger(spark, str(tmp_path / "none"), lines=True).count() == 0
    ledger = run(spark, [ITEM], [PAGE], [IMAGE]).accepted.drop("pos")
    write_ledger(ledger, str(tmp_path / "ledger"))
    assert read_ledger(spark, str(tmp_path / "ledger"), lines=True).collect() == ledger.collect()
    ledger_doc = tmp_path / "ledger.json"
    ledger_doc.write_text(json.dumps({"schema_version": 1, "products": [{"id": "a", "sizes": ["S"]}]}))
    assert [(r.id, r.sizes) for r in read_ledger(spark, str(ledger_doc)).collect()] == [("a", ["S"])]
