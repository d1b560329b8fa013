import re
from collections import Counter, defaultdict

import pytest

from stockweave.llm import mixing, queries
from stockweave.llm.common import numbered, text_of
from tests.llm import cases


def sized(docs):
    return numbered(docs.select("doc_id", "source", mixing.word_count(text_of()).alias("size")), "row_id", "test")


def targets(sizes, weights=(3.0, 1.0, 2.0), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        rate = (total - sum(most * sizes[s] for s in capped)) / (sum(weight[s] for s in order if s not in capped) or 1)
        more = {s for s in order if s not in capped and weight[s] * rate > most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in capped else weight[s] * rate for s in order}
        capped |= more


def check(rows):
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r["size"] * r.copies
        largest[r.source] = max(largest[r.source], r["size"])
        assert 0 <= r.copies <= 2
    wanted = targets(dict(sizes))
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(wanted[r.source])
    for source in sizes:
        # one residual document per source is rounded on its own
        assert abs(taken[source] - wanted[source]) <= largest[source]


@pytest.mark.parametrize("block_rows", [2000, 3])
def test_sources_meet_targets(spark, block_rows, monkeypatch):
    docs = cases.documents(spark, n=60)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    monkeypatch.setattr(mixing.round_copies, "__defaults__", (17, block_rows))
    check(mixing.mix(sized(docs)).collect())


def test_reruns_agree(spark):
    docs = cases.documents(spark)
    rows = sized(docs)
    first, second = (Counter(map(tuple, mixing.mix(rows.repartition(n)).collect())) for n in (1, 3))
    assert first == second


def test_expectation_is_kept(spark):
    rows = spark.range(4).selectExpr("id AS row_id", "'a' AS source", "id + 1 AS size", "0L AS copies", "0.3D AS part", "4L AS n_docs").cache()
    taken = defaultdict(int)
    for seed in range(60):
        for r in mixing.round_copies(rows, seed).collect():
            taken[r.row_id] += r.copies
    assert all(6 <= n <= 32 for n in taken.values())  # 18 expected, over 60 draws


def test_words_and_query(spark, tables):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = queries.queries()["op5_mix_sources"](spark, tables).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r["size"] == len(re.findall("[^\x20\x09-\x0d]+", docs[r.doc_id].text or ""))
        assert r.taken == r["size"] * r.copies


def test_mixed_documents_repeat_rows(spark):
    docs = cases.with_clashes(cases.documents(spark))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    before, after = (Counter(map(tuple, d.collect())) for d in (docs, mixed))
    assert set(after) <= set(before)
    assert all(n <= 2 * before[row] for row, n in after.items())
    assert mixing.mixed_documents(cases.empty(docs)).count() == 0
