from collections import Counter

import numpy as np

import corpus_pipeline
from stockweave.llm import pieces, queries, toxicity
from tests.llm import cases
from tests.llm.test_mixing import targets
from tests.llm.test_pieces import VOCABULARY
from tests.llm.test_secret_scan import brute_redacted
from tests.llm.test_simhash import brute as brute_components


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_against_brute_force(spark, tables):
    """Every stage on all rows of its predecessor."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{tables}/labels.parquet").filter(~toxicity.held_out())
    lexicon = toxicity.learn(toxicity.training_rows(docs, labels))

    clean = stage("toxicity")(spark, docs, tables)
    assert clean.columns == columns
    kept = {r.doc_id: r for r in docs.collect() if lexicon.score(lexicon.strength(toxicity.fold(r.text))) < 0.5}
    assert {r.doc_id for r in clean.collect()} == set(kept)

    single = stage("simhash_near_dedup")(spark, clean, tables)
    wanted = {c for _, _, c in brute_components([(i, r.text) for i, r in kept.items()])}
    assert Counter(map(tuple, single.collect())) == Counter(tuple(kept[i]) for i in wanted)

    masked = stage("secret_scan")(spark, single, tables)
    rows = {r.doc_id: r for r in masked.collect()}
    assert masked.columns == columns and set(rows) == wanted
    for i, r in rows.items():
        text = kept[i].text and brute_redacted(kept[i].text)
        assert r.text == text and r.n_chars == len(text)

    mixed = stage("source_mix")(spark, masked, tables)
    taken = Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == columns and max(taken.values()) <= 2
    size = {i: len((r.text or "").split()) for i, r in rows.items()}
    sizes, words, largest = Counter(), Counter(), Counter()
    for i, r in rows.items():
        sizes[r.source] += size[i]
        words[r.source] += size[i] * taken[i]
        largest[r.source] = max(largest[r.source], size[i])
    for source, target in targets(dict(sizes)).items():
        assert abs(words[source] - target) <= largest[source]

    ids = stage("sentencepiece")(spark, mixed, tables).collect()
    assert Counter(r.doc_id for r in ids) == taken
    assert all(r.exact and VOCABULARY.decode(np.array(r.ids)) == rows[r.doc_id].text for r in ids)


def test_odd_rows_pass_every_stage(spark, tables):
    for docs in (cases.with_clashes(cases.documents(spark)), cases.empty(cases.documents(spark))):
        for name, run in corpus_pipeline.STAGES:
            after = run(spark, docs, tables)
            if name != "sentencepiece":
                assert after.columns == docs.columns
                docs = spark.createDataFrame(after.collect(), after.schema)
        assert after.columns[:2] == ["doc_id", "ids"]


def test_run(spark, tables):
    rows = corpus_pipeline.run(spark, tables).collect()
    assert rows and all(r.exact for r in rows)
    assert pieces.load_model(queries.PIECES_MODEL)
