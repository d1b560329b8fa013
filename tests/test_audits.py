import time

import pytest

from stockweave.operators import audits as H


def pages(spark, *texts):
    return spark.createDataFrame([(i, t, "/a/x.html") for i, t in enumerate(texts)], "id int, html string, path string")


def references(spark, *texts):
    return [(r.id, r.reference) for r in H.page_references(pages(spark, *texts), "id", "path").orderBy("id").collect()]


@pytest.mark.parametrize("opener", ["<a ", "<!--", "<script>", '<a "', "<script ", "<style>x</style", "<a href='x", "<"])
def test_a_broken_page_is_read_once(spark, opener):
    page = pages(spark, opener * (1_000_000 // len(opener)))
    started = time.monotonic()
    assert H.images_without_alt(page, "id").collect() == [] and H.page_references(page, "id", "path").collect() == []
    assert time.monotonic() - started < 10


def test_what_is_never_closed_takes_the_rest(spark):
    found = references(
        spark,
        "<a href=b.html><!-- <a href=c.html>",
        "<a href=b.html><script src=s.js> <a href=c.html>",
        '<a href=b.html><a href="c.html> <a href=d.html>',
        "<a href=b.html><a href=c.html",
        "<!-- x --><a title='>' href=b.html><style>a</style ><a href=c.html>",
    )
    assert found == [(0, "b.html"), (1, "b.html"), (1, "s.js"), (2, "b.html"), (3, "b.html"), (4, "b.html"), (4, "c.html")]
