import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stockweave.llm import queries, toxicity
from tests.llm import cases

LEXICON = toxicity.Lexicon(((" idiot ", 5.0), (" trash ", 4.0), (" moro", 2.0)), ("trash can", "not an idiot"))


def found(text, lexicon=LEXICON):
    return lexicon.measure(toxicity.fold(text))


@pytest.mark.parametrize(
    "text, total",
    [
        ("You idiot", 5.0),
        ("IDIOT!", 5.0),
        ("an 1d10t", 5.0),
        ("іdіоt", 5.0),  # Cyrillic letters
        ("i​d­iot", 5.0),
        ("ｉｄｉｏｔ", 5.0),
        ("“idiot”", 5.0),
        ("idiot$$$ trash###", 9.0),
        ("tr@sh", 4.0),
        ("idiotic", 0.0),
        ("videotrash", 0.0),
        ("a moron and morose", 4.0),
        ("the trash can", 0.0),
        ("the trash can is trash", 4.0),
        ("not an idiot", 0.0),
        ("", 0.0),
        (None, 0.0),
    ],
)
def test_folding_and_matching(text, total):
    assert found(text)[0] == total


def test_longer_texts_score_lower():
    short, long = ("idiot " + "word " * n for n in (5, 500))
    assert LEXICON.strength(toxicity.fold(short)) > LEXICON.strength(toxicity.fold(long)) > 0


def brute_measure(text, lexicon):
    """Every entry and exception at every place, without an automaton."""
    padded = toxicity._padded(toxicity.fold(text))

    def places(pattern):
        return [(i, i + len(pattern)) for i in range(len(padded)) if padded.startswith(pattern, i)]

    shields = [p for e in lexicon.exceptions for p in places(toxicity._padded(toxicity.fold(e)))]
    return sum(w for e, w in lexicon.entries for p in places(e) if not any(s[0] <= p[0] and p[1] <= s[1] for s in shields))


def test_scores_match_brute_force(spark):
    docs = cases.with_clashes(cases.documents(spark))
    extra = [(900, "trash can and idiot " * 40), (901, "mоrоn " * 3), (901, "mоrоn " * 3)]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    rows = toxicity.score_toxicity(docs, LEXICON).collect()
    wanted = []
    for r in docs.collect():
        strength = brute_measure(r.text, LEXICON) / (len(toxicity.fold(r.text)) + toxicity.LENGTH_OFFSET) ** 0.5
        wanted.append((r.doc_id, round(LEXICON.score(strength), 9)))
    assert Counter((r.doc_id, round(r.score, 9)) for r in rows) == Counter(wanted)
    assert all(r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.score_toxicity(cases.empty(docs), LEXICON).count() == 0
    clean = toxicity.drop_toxic(docs, LEXICON)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not r.predicted for r in rows)


def test_learning_without_toxic_rows(spark):
    docs = cases.documents(spark)
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    for part in (labels, cases.empty(labels)):
        lexicon = toxicity.learn(toxicity.training_rows(docs, part))
        assert not lexicon.entries
        assert toxicity.score_toxicity(docs, lexicon).filter("predicted = 1").count() == 0


def test_training_rows_are_bounded(spark):
    docs = spark.range(50).selectExpr("id AS doc_id", "'a' AS text")
    labels = spark.range(50).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    assert toxicity.training_rows(docs, labels.union(labels), 10).count() == 10


def test_held_out_is_crc32(spark):
    rows = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", toxicity.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "toxic")
    rows = queries.queries()["op2_toxicity"](spark, d).filter("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").toPandas()
    positive, negative = (rows[rows.toxic == t].score for t in (1, 0))
    area = (positive.to_numpy()[:, None] > negative.to_numpy()).mean() + 0.5 * (positive.to_numpy()[:, None] == negative.to_numpy()).mean()
    assert area > 0.94
    assert (rows.predicted == rows.toxic).mean() > 0.97
