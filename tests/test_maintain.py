import html

from pyspark.sql import functions as F

from stockweave.functions.text import unescape
from stockweave.operators import maintain as U
from stockweave.operators import quality as Q
from stockweave.operators.audits import contact_audit, images_without_alt, reference_audit
from stockweave.operators.catalog import active_catalog, orderable_products
from stockweave.operators.images import select_image_evidence
from stockweave.schemas import IMAGE_RESPONSES, ORDER_ITEMS, PAGE_EVIDENCE, RETIRED, UNAVAILABLE


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


PRODUCT = "id string, name string, price_minor bigint"


def test_retire_keeps_rows_that_orders_refer_to(spark):
    products = frame(spark, [("a", "A", 1), ("b", "B", 2), ("c", "C", 3)], PRODUCT)
    source = frame(spark, [("s", "S", None)], PRODUCT)
    items = frame(spark, [("o1", 1, "a", "A", "men", 1, 1, "", "")], ORDER_ITEMS)
    none, retired = spark.createDataFrame([], UNAVAILABLE), spark.createDataFrame([], RETIRED)
    records = frame(
        spark,
        [("a", "Old", "u", ["DETAILS_INSUFFICIENT"]), ("b", None, None, []), ("s", "S", None, ["X"]), (None, "n", None, [])],
        "product_id string, title string, source_url string, failure_reasons array<string>",
    )
    after = U.retire(products, source, none, retired, items, records, "2026-01-01")
    ids = lambda n, c="id": sorted(r[0] for r in after[n].select(c).collect())
    assert ids("products") == ["a", "c"] and ids("source_products") == [] and ids("unavailable") == ["a"]
    rows = {r.product_id: (r.name, r.failure_reason) for r in after["retired"].collect()}
    assert rows == {"a": ("Old", ["DETAILS_INSUFFICIENT"]), "b": ("b", [U.DEFAULT_REASON]), "s": ("S", ["X"])}
    again = U.retire(after["products"], after["source_products"], after["unavailable"], after["retired"], items,
                     records, "2027-01-01")
    for name, rows_after in after.items():
        assert sorted(map(str, again[name].collect())) == sorted(map(str, rows_after.collect()))
    catalog = active_catalog(after["products"], after["source_products"], after["unavailable"], after["retired"])
    assert [r.id for r in catalog.collect()] == ["c"]
    assert [r.id for r in orderable_products(after["products"], after["unavailable"], after["retired"]).collect()] == ["c"]
    active = U.activate(after["products"], after["source_products"], after["unavailable"], after["retired"],
                        frame(spark, [("a", "New", 9)], PRODUCT))
    assert active["unavailable"].count() == 0 and active["retired"].count() == 2
    assert {r.id: r.price_minor for r in active["products"].collect()} == {"a": 9, "c": 3}


def test_unavailable_products_lose_their_price_only_in_the_catalog(spark):
    products = frame(spark, [("a", "A", 1), ("b", "B", 2)], PRODUCT)
    source = frame(spark, [("s", "S", None)], PRODUCT)
    hidden = frame(spark, [("a", "x")], UNAVAILABLE)
    catalog = active_catalog(products, source, hidden, spark.createDataFrame([], RETIRED))
    assert {r.id: r.price_minor for r in catalog.collect()} == {"a": None, "b": 2, "s": None}


def test_inserts_are_repeatable_and_guarded(spark):
    orders = frame(spark, [("o1", "h1"), ("o2", "h2")], "id string, request_hash string")
    base = frame(spark, [("o1", 1, 100)], "order_id string, line_no int, price bigint")
    incoming = frame(
        spark, [("o1", 1, 999, "h1"), ("o1", 2, 5, "h1"), ("o2", 1, 7, "other")],
        "order_id string, line_no int, price bigint, request_hash string")
    after = U.insert_items_if_matching(base, incoming, orders, "price")
    assert sorted(map(tuple, after.collect())) == [("o1", 1, 100), ("o1", 2, 5)]
    assert U.insert_items_if_matching(after, incoming, orders, "price").count() == 2
    twice = incoming.withColumn("price", F.col("price") + 1).unionByName(incoming)
    assert sorted(map(tuple, U.insert_items_if_matching(base, twice, orders, "price").collect())) == [("o1", 1, 100), ("o1", 2, 5)]


def test_upsert_twice_changes_nothing_more(spark):
    base = frame(spark, [("a", "A", 1), ("b", "B", 2)], PRODUCT)
    new = frame(spark, [("b", "B2", 3), ("c", "C", 4)], PRODUCT)
    once = U.upsert(base, new)
    assert sorted(map(tuple, once.collect())) == [("a", "A", 1), ("b", "B2", 3), ("c", "C", 4)]
    assert sorted(map(tuple, U.upsert(once, new).collect())) == sorted(map(tuple, once.collect()))


def test_ledger_merge(spark):
    ledger = frame(spark, [("a", "old a"), ("b", "old b"), ("d", "old d")], "id string, name string")
    accepted = frame(spark, [(0, "a", "first"), (2, "a", "new a"), (3, "c", "new c"), (4, "b", "new b")],
                     "pos bigint, id string, name string")
    results = frame(spark, [(0, "a", "ACCEPTED"), (2, "a", "ACCEPTED"), (3, "c", "ACCEPTED"), (4, "b", "ACCEPTED"),
                            (5, "b", "EXISTING"), (6, "d", "REJECTED"), (7, "e", "REJECTED")],
                    "pos bigint, product_id string, status string")
    merged = U.merge_ledger(ledger, accepted, results)
    assert {r.id: r.name for r in merged.collect()} == {"a": "new a", "b": "old b", "c": "new c", "d": "old d"}
    assert [r.product_id for r in U.retire_records(results, merged).collect()] == ["e"]
    counts = U.import_counts(frame(spark, [("x",)], "id string"), merged, U.retire_records(results, merged))
    assert tuple(counts.collect()[0]) == (5, 4, 1)


def test_constraints(spark):
    rows = [(f"q{i}", 1, "p", "n", "men", 5.0, q) for i, q in enumerate((0.0, -1.0, 11.0, 1.5, 3.0))] + [
        ("p", 1, "p", "n", "men", 1.5, 1.0), ("c", 0, "p", "n", "x", 5.0, None)]
    items = frame(spark, rows, "order_id string, line_no int, product_id string, product_name string, "
                               "category string, unit_price_minor double, quantity double")
    found = {}
    for r in Q.check_constraints(items, ["order_id"], Q.order_item_rules()).collect():
        found.setdefault(r.order_id, set()).add(r.rule)
    assert found == {"q0": {"quantity_range"}, "q1": {"quantity_range"}, "q2": {"quantity_range"},
                     "q3": {"quantity_whole"}, "p": {"unit_price_whole"},
                     "c": {"line_no_range", "category_known", "quantity_required"}}
    lost = Q.orphans(items, frame(spark, [("other",)], "id string"), "product_id", "id")
    assert lost.count() == len(rows)


def test_unique_where_set(spark):
    rows = frame(spark, [("s", "1"), ("s", "1"), ("s", None), ("s", None), ("t", "1")], "store string, sku string")
    assert [tuple(r) for r in Q.unique_where_not_null(rows, ["store", "sku"]).collect()] == [("s", "1", 2)]


def test_contact_audit(spark):
    texts = ["mail a@example.com", "mail a@real.org and b@example.com", "call +91 98765 43210 now", "id 198765432101",
             "9876543210", "key ghp_" + "a" * 30, "x a@b.co 7000012345"]
    docs = frame(spark, list(enumerate(texts)), "id int, text string")
    found = {}
    for r in contact_audit(docs, "id").collect():
        found.setdefault(r.id, []).append(r.issue.split()[0] + r.issue.split()[1])
    assert found == {1: ["Non-demoemail"], 2: ["Possiblereal"], 4: ["Possiblereal"], 5: ["Possiblecredential"],
                     6: ["Non-demoemail", "Possiblereal"]}


def test_reference_audit(spark):
    html = """<!-- <a href="/gone-in-comment"> --><script src="/js/app.js">var x='<a href="/in-script">';</script>
        <a href='sub/page.html?x=1#y'>1</a> <a HREF=../up.html>2</a> <A href="/dir/">3</A> <a href="https://x.y/z">4</a>
        <a href="#top">5</a> <a href="mailto:a@b.c">6</a> <img src="/a%20b.png" alt="x"><img src=/none.png><img alt="" src="">"""
    pages = frame(spark, [("p", "docs/index.html", html)], "page string, path string, html string")
    known = frame(spark, [(p,) for p in ("js/app.js", "docs/sub/page.html", "dir/index.html", "a b.png")], "path string")
    broken = reference_audit(pages, known, "page", "path").collect()
    assert sorted((r.reference, r.target) for r in broken) == [("../up.html", "up.html"), ("/none.png", "none.png")]
    assert [tuple(r) for r in images_without_alt(pages, "page").collect()] == [("p", 2)]


def test_image_evidence(spark):
    hosts = "https://cdn.shopify.com/"
    urls_of = {
        "first": [hosts + "1.jpg", hosts + "2.jpg"],
        "second": [hosts + "1.jpg", hosts + "2.jpg"],
        "none": [hosts + "1.jpg", hosts + "2.jpg"],
        "blocked": ["https://other.example/1.jpg"],
        "empty": [],
        "odd": ["not a url"],
        "mismatch": [hosts + "1.jpg"],
    }
    products = frame(spark, [(k, f"https://s.example/{k}", u) for k, u in urls_of.items()],
                     "product_id string, canonical_url string, image_urls array<string>")
    pages = frame(spark, [(k, "accessible", 200, f"https://www.s.example/{k}/", k != "mismatch", ["image"], []) for k in urls_of],
                  PAGE_EVIDENCE)
    good, bad = (200, "image/png", True, 10), (404, "text/html", False, 0)
    answers = [("first", 0, good), ("first", 1, good), ("second", 0, bad), ("second", 1, good), ("none", 0, bad),
               ("none", 1, (200, "text/html", True, 5))]
    responses = frame(spark, [(k, urls_of[k][n], n, *a) for k, n, a in answers], IMAGE_RESPONSES)
    found = {r.product_id: (r.status, r.image_url, r.failure_reason)
             for r in select_image_evidence(products, pages, responses).collect()}
    assert found == {
        "first": ("verified", hosts + "1.jpg", None),
        "second": ("verified", hosts + "2.jpg", None),
        "none": ("rejected", hosts + "2.jpg", "IMAGE_INVALID_CONTENT"),
        "blocked": ("rejected", "https://other.example/1.jpg", "IMAGE_CSP_BLOCKED"),
        "empty": ("rejected", None, "IMAGE_MISSING"),
        "odd": ("rejected", "not a url", "IMAGE_BROKEN"),
        "mismatch": ("rejected", hosts + "1.jpg", "PRODUCT_MISMATCH"),
    }


def test_tags_of_any_length(spark):
    """A megabyte in one tag, closed or not, quoted or not, is no deep recursion."""
    x = "x" * 1_000_000
    pages = frame(spark, [
        ("open", f"<a {x}"), ("long", f"<img {x}>"), ("quoted", f'<img alt="{x}">'), ("many", "<img " + 'a="b" ' * 100_000 + ">"),
        ("bare", "<img src=" + x + ">")], "page string, html string")
    found = {r.page: r.images for r in images_without_alt(pages, "page").collect()}
    assert found == {"long": 1, "many": 1, "bare": 1}


def test_attributes_are_read_in_sequence(spark):
    pages = frame(spark, [
        ("value", '<img alt="a src=x.png b" src="y.png">'), ("title", '<img title="no alt=here" src=z.png>'),
        ("last", "<img alt=x src=a.png alt='' src=b.png>"), ("entity", '<a href="a&#x2F;b&period;html">')],
        "page string, html string").withColumn("path", F.lit("index.html"))
    assert {r.page for r in images_without_alt(pages, "page").collect()} == {"title", "last"}
    broken = reference_audit(pages, frame(spark, [("none",)], "path string"), "page", "path").collect()
    assert sorted((r.page, r.target) for r in broken) == [
        ("entity", "a/b.html"), ("last", "b.png"), ("title", "z.png"), ("value", "y.png")]


def test_character_references(spark):
    texts = ["&amp;&lt;x&quot;", "&eacute; & &", "&#128;&#x80;&#0;&#xD800;&#99999999999;&#x1F600;", "&hearts;&amp", "&#", "&#x;",
             "&#65b&#x41;&AMP;", ""]
    rows = frame(spark, [(t,) for t in texts], "c string").select("c", unescape(F.col("c")).alias("u")).collect()
    assert [(r.c, r.u) for r in rows] == [(t, html.unescape(t)) for t in texts]
