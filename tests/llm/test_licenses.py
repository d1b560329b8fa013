import random
import re
from collections import Counter

import pytest

from stockweave.llm import licenses
from stockweave.llm.licenses import NOTICES, PHRASES, Template
from tests.llm import cases

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute_base(text):
    """n_words, n_base, first_word, last_word and base_labels from the phrases alone."""
    words, places = words_of(text), []
    for phrase in PHRASES:
        want = phrase.text.split()
        places += [(i, phrase.label) for i in range(len(words)) if words[i : i + len(want)] == want]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def scanned(spark, texts, templates=licenses.TEMPLATES):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for _, r in sorted((r.doc_id, r) for r in licenses.scan_licenses(docs, templates).collect())]


def base_of(row):
    return row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels


def test_base_against_brute_force(spark):
    rnd = random.Random(5)
    pieces = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "MIT License", "CC-BY", "CC\nBY", "über", "License,", "É", "0"]
    texts = [" ".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    texts += [None, "", "...", "cc by cc by", "mit license " * 3000, "GNU GENERAL PUBLIC LICENSE", "cc\x7fby", "ccby"]
    for row, text in zip(scanned(spark, texts), texts, strict=True):
        assert base_of(row) == brute_base(text), text


def test_odd_rows(spark):
    docs = cases.documents(spark)
    for rows in (docs, cases.with_clashes(docs)):
        found = Counter((r.doc_id, *base_of(r)) for r in licenses.scan_licenses(rows).collect())
        assert found == Counter((r.doc_id, *brute_base(r.text)) for r in docs.collect())
    assert licenses.scan_licenses(cases.empty(docs)).collect() == []


def test_every_template_is_found_by_its_own_text(spark):
    for row, template in zip(scanned(spark, [f"before {t.text} after" for t in licenses.TEMPLATES]), licenses.TEMPLATES, strict=True):
        assert template.label in row.labels.split(",") and row.score == 1.0
        assert (1, 1 + len(template.words), template.label, 1.0) in [tuple(s) for s in row.spans]


@pytest.mark.parametrize("notice", NOTICES, ids=lambda t: t.label)
def test_changed_notices(spark, notice):
    """A lost, an added and a changed word leave a notice; half of it, or its words shuffled, do not."""
    words, rnd = notice.words, random.Random(1)
    if len(words) < 24:
        pytest.skip("too short to lose words")
    third = len(words) // 3
    lost, added, changed = words[:third] + words[third + 1 :], words[:third] + ["very"] + words[third:], [*words]
    changed[third] = "other"
    shuffled = [*words]
    rnd.shuffle(shuffled)
    rows = scanned(spark, [" ".join(w) for w in (lost, added, changed, words[: len(words) // 2], shuffled)], (notice,))
    assert [r.labels for r in rows] == [notice.label] * 3 + [""] * 2
    assert all(licenses.LEAST <= r.score < 1 for r in rows[:1] + rows[2:3]) and [r.score for r in rows[3:]] == [0.0, 0.0]


def test_statements_tell_versions_apart(spark):
    texts = ["Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0.", "licensed under cc by nc 3.0", "the GNU General Public License, version 3."]
    assert [r.labels for r in scanned(spark, texts)] == ["cc-by,cc-by-nc-4.0", "cc-by,cc-by-4.0", "cc-by", "gpl,gpl-3.0"]


def test_merging_and_repeats(spark):
    notice = Template("n", " ".join(f"w{i}" for i in range(40)))
    copy, gap = notice.words[:20] + ["x"] * 3 + notice.words[20:], ["y"] * 5
    (row,) = scanned(spark, [" ".join(copy + gap + notice.words + notice.words)], (notice,))
    assert [(s.first, s.end, s.coverage) for s in row.spans] == [(0, 43, 1.0), (48, 88, 1.0), (88, 128, 1.0)]


def test_many_templates_take_the_shuffled_join(spark, monkeypatch):
    texts = [t.text for t in licenses.TEMPLATES] + ["", None, "mit license, cc by"]
    few = scanned(spark, texts)
    monkeypatch.setattr(licenses, "LISTED_RUNS", 10)
    assert scanned(spark, texts) == few
    assert base_of(scanned(spark, ["mit license"], ())[0]) == (2, 0, None, None, "")


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "mit license")], "doc_id long, text string")
    hits = licenses.template_hits(docs.select("doc_id", "text"), licenses.TEMPLATES)
    plan = licenses.template_spans(hits, licenses.TEMPLATES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
