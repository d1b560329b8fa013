import hashlib
from collections import Counter

from pyspark.sql import functions as F

from stockweave.llm import warc

RECORDS = "file long, offset long, length long, digest string"


def test_record_bytes(spark):
    rows = spark.createDataFrame([("http://a/é", "<p>ü"), (None, None)], "url string, html string")
    found = [bytes(r[0]) for r in rows.select(warc.record(F.col("url"), F.col("html"))).collect()]
    head = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: {}\r\nContent-Type: text/html\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    assert found == [head.format("http://a/é", 5, "<p>ü").encode(), head.format("", 0, "").encode()]


def test_layout(spark):
    rows = [(None, 5), (3, 10), (1, 7), (2, 7), (2, 7), (9, 4)]
    found = warc.lay_out(spark.createDataFrame(rows, "page_id long, length long"), ["page_id"], file_records=4).collect()
    assert Counter((r.page_id, r.file, r.offset) for r in found) == Counter(
        [(None, 0, 0), (1, 0, 5), (2, 0, 12), (2, 0, 19), (3, 1, 0), (9, 1, 10)]
    )


def collection(n_files=40, n_records=30, length=20_000):
    return {(f, i * length): (length, hashlib.sha256(f"{f}/{i}".encode()).hexdigest()) for f in range(n_files) for i in range(n_records)}


def table(spark, records):
    return spark.createDataFrame([(f, o, n, d) for (f, o), (n, d) in records.items()], RECORDS)


def brute(one, two):
    out = []
    for key in one.keys() | two.keys():
        a, b = one.get(key), two.get(key)
        if a != b:
            out.append((*key, a and a[0], b and b[0], "missing" if b is None else "extra" if a is None else "changed"))
    return Counter(out)


def test_locates_every_fault(spark):
    one, two = collection(), collection()
    two[0, 0] = (20_000, "x")
    two[7, 40_000] = (19_999, two[7, 40_000][1])
    del two[39, 29 * 20_000]
    del two[20, 0]
    two[45, 0] = (1, "y")  # a file that the primary lacks
    two[3, 30 * 20_000] = (5, "z")
    found = warc.audit(table(spark, one), table(spark, two)).collect()
    assert Counter(map(tuple, found)) == brute(one, two)


def test_equal_replicas_end_at_the_root(spark, monkeypatch):
    one = table(spark, collection(3, 4))
    assert warc.audit(one, one.repartition(3)).count() == 0


def test_empty_replicas(spark):
    one, none = table(spark, collection(2, 2)), table(spark, {(0, 0): (1, "x")}).limit(0)
    assert warc.audit(none, none).count() == 0
    assert Counter(r.fault for r in warc.audit(one, none).collect()) == {"missing": 4}
    assert Counter(r.fault for r in warc.audit(none, one).collect()) == {"extra": 4}


def test_only_suspect_branches_are_compared(spark, monkeypatch):
    """Below the root, a level compares the children of differing nodes and no others."""
    seen = []
    settle = warc.settle_table

    def spy(df, name):
        out = settle(df, name)
        if name == "warc-suspects":
            seen.append(out.count())
        return out

    monkeypatch.setattr(warc, "settle_table", spy)
    one, two = collection(), collection()
    two[11, 60_000] = (20_000, "x")
    assert warc.audit(table(spark, one), table(spark, two)).count() == 1
    assert seen == [1] * warc.Shape.of(table(spark, one)).levels
