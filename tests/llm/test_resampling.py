import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stockweave.llm import resampling
from tests.llm import cases

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, max_run):
    words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, max_run + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, max_run=1, buckets=10_000, least=20, share=(10, 100)):
    """doc_id, n_words, n_features, weight, score, rank of rows (doc_id, text), whole texts at a time."""

    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    cut = [(i, *features(t, max_run)) for i, t in rows]
    s, t = Counter(bucket(f) for _, _, fs in cut for f in fs), Counter(bucket(f) for x in target for f in features(x, max_run)[1])
    total = sum(t.values()) + buckets
    all_s = sum(s.values()) + buckets
    gain = {b: math.floor(1000 * math.log(float(t[b] + 1) * all_s / (float(s[b] + 1) * total))) for b in s}
    out = []
    for i, n_words, fs in cut:
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n_words, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: len(able) * share[0] // share[1]], 1):
        row[5] = rank
    return Counter(map(tuple, out))


@pytest.mark.parametrize(("max_run", "buckets", "share"), [(1, 10_000, (10, 100)), (3, 97, (1, 2))])
def test_against_brute_force(spark, max_run, buckets, share):
    docs = cases.documents(spark)
    # lines that repeat, lines shorter than a run, and blank ones in between
    more = ["a b\nc\n\nd e f\na b\nc d", "a b\na b\na b\n" * 12, "\n\n x", "a b " * 15 + "\nq"]
    docs = docs.unionByName(spark.createDataFrame([(900 + i, t, "en", "a", 1) for i, t in enumerate(more)], docs.schema))
    target = spark.createDataFrame([("a b c d e f",), ("gg\nab ab",), (None,), ("",)], "text string")
    rows, goal = [(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()]
    wanted = brute(rows, goal, max_run, buckets, share=share)
    for table in (docs, cases.with_clashes(docs)):
        found = resampling.resample(table, target, share, max_run=max_run, buckets=buckets)
        assert Counter(map(tuple, found.collect())) == wanted
    assert any(r[5] for r in wanted)


def test_empty_tables(spark):
    docs, target = cases.documents(spark), spark.createDataFrame([("a b",)], "text string")
    assert resampling.resample(cases.empty(docs), target).collect() == []
    found = resampling.resample(docs, target.limit(0))
    assert Counter(map(tuple, found.collect())) == brute([(r.doc_id, r.text) for r in docs.collect()], [])


def test_a_line_is_cut_into_words_once(spark):
    """A line of many texts is one row of the feature table, and its counts reach the totals as often as it occurs."""
    docs = spark.createDataFrame([(i, f"the same line\nnumber {i}") for i in range(500)], "doc_id long, text string")
    lines = resampling.line_features(docs)
    assert lines.count() == 501 and lines.agg(F.max("times")).first()[0] == 500
    totals = resampling.bucket_totals(lines, resampling.cut_texts(docs))
    assert {r.bucket: r.n for r in totals.collect()}[zlib.crc32(b"same") % 10_000] >= 500
    assert totals.agg(F.sum("n")).first()[0] == 500 * 5


def test_runs_over_line_ends():
    hashed = resampling._Buckets(1 << 30)
    text = b"a b\nc\nd e f"
    lines = [resampling.words_of(x) for x in text.split(b"\n")]
    inside = [x for line in lines for x in hashed.inside(line, 4)]
    assert sorted(inside + hashed.across(lines, 4)) == sorted(zlib.crc32(f.encode()) % (1 << 30) for f in features(text.decode(), 4)[1])
