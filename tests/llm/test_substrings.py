import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from stockweave.llm import substrings
from tests.llm import cases


def brute(rows):
    """Every 100-byte string, in order of (doc_id, text checksum)."""
    import zlib

    seen, out = set(), {}
    order = sorted({(substrings.LAST if i is None else i, zlib.crc32((t or "").encode()), t or "") for i, t in rows})
    for i, _, text in order:
        data = text.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            string = data[p : p + 100]
            if string in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(string)
        kept = bytes(x for x, g in zip(data, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i, text] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def compare(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    wanted = brute(rows)
    found = substrings.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    expected = [(i, *wanted[substrings.LAST if i is None else i, t or ""]) for i, t in rows]
    assert Counter(map(tuple, found)) == Counter(expected)


def crossing(spark):
    """Passages that start and end anywhere, periodic texts and multi-byte characters."""
    rnd = random.Random(5)
    base = "".join(rnd.choice("abcd ") for _ in range(3000))
    texts = []
    for i in range(72):
        a = rnd.randrange(2000)
        texts.append(
            [
                "x" * rnd.randrange(30) + base[a : a + rnd.randrange(90, 600)] + "".join(rnd.choice("éz") for _ in range(rnd.randrange(200))),
                "ab" * rnd.randrange(300),
                "a" * rnd.randrange(400),
                "é" * rnd.randrange(120),
            ][i % 4]
        )
    return spark.createDataFrame(list(zip(rnd.sample(range(1000), len(texts)), texts)), "doc_id long, text string")


def test_matches_brute_force(spark):
    compare(crossing(spark).repartition(5))


def test_parts_of_one_anchor_meet(spark, monkeypatch):
    monkeypatch.setattr(substrings, "PART", 2)
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 1 << 10)
    compare(crossing(spark).repartition(5))


def test_odd_rows(spark):
    docs = cases.documents(spark)
    compare(docs)
    assert substrings.remove_repeats(cases.empty(docs)).count() == 0


def test_clashing_columns(spark):
    docs = cases.with_clashes(cases.documents(spark, n=6))
    assert substrings.remove_repeats(docs).count() == docs.count()


def test_merge_sort_orders_suffixes():
    rnd = random.Random(1)
    data = bytes(rnd.choice(b"ab") for _ in range(2000))
    prefixes = substrings.Prefixes(np.frombuffer(data, np.uint8))
    where = np.array([rnd.randrange(1900) for _ in range(500)])
    bucket = np.sort(np.array([rnd.randrange(4) for _ in range(500)]))
    order = substrings.merge_sort(prefixes, where, bucket)
    wanted = sorted(range(500), key=lambda i: (bucket[i], data[where[i] : where[i] + 100], i))
    assert order.tolist() == wanted


def test_equal_hashes_of_different_strings_are_noticed(spark):
    data = np.frombuffer(b"a" * 100 + b"b" * 100 + b"a" * 100, np.uint8)
    assert substrings._equal_bytes(data, np.array([0, 0]), np.array([200, 100])).tolist() == [True, False]


@pytest.mark.parametrize("most", [1, 7, 100])
def test_common_extension(most):
    data = b"abcabcabd" + b"q" * 120
    prefixes = substrings.Prefixes(np.frombuffer(data, np.uint8))
    found = prefixes.common(np.array([0, 9]), np.array([3, 10]), most)
    assert found.tolist() == [min(most, 5), most]


def rows_of(texts, gram=7, parts=1):
    """Contexts of one anchor, in the middle of 101 bytes."""
    each = {"gram": gram, "part": 0, "parts": parts, "shape": 1 * substrings.LENGTH + 40, "tie": 0, "start": 0}
    return pd.DataFrame([{**each, "doc": i, "bytes": t} for i, t in enumerate(texts)])


def lost(rows):
    spans, left = substrings._compare_contexts(rows)
    assert not len(left)  # one part
    return sorted(zip(spans["doc"], spans["start"], spans["end"]))


def test_strings_that_meet_no_other_are_not_sorted(monkeypatch):
    rnd = random.Random(2)
    middle = bytes(rnd.choice(b"abc") for _ in range(40))
    texts = [bytes(rnd.choice(b"xyz") for _ in range(30)) + middle + bytes(rnd.choice(b"xyz") for _ in range(31)) for _ in range(200)]
    compared = []
    common = substrings.Prefixes.common
    monkeypatch.setattr(substrings.Prefixes, "common", lambda self, a, b, most: (compared.append(len(a)), common(self, a, b, most))[1])
    assert lost(rows_of(texts)) == []
    assert sum(compared) == 0
    # the first string of the last text is that of the first, its second is not
    texts.append(texts[0][:100] + b"w")
    assert lost(rows_of(texts)) == [(200, 0, 100)]
    assert 0 < sum(compared) < 10


def test_unlike_strings_of_a_class_are_told_apart(monkeypatch):
    rnd = random.Random(4)
    base = [bytes(rnd.choice(b"ab") for _ in range(101)) for _ in range(3)]
    texts = [rnd.choice(base)[:100] + rnd.choice([b"a", b"b"]) for _ in range(30)]
    wanted = lost(rows_of(texts))
    monkeypatch.setattr(substrings, "_classes", lambda values: (np.arange(len(values)), np.zeros(len(values), np.int64)))
    assert wanted and lost(rows_of(texts)) == wanted


def test_classes_are_in_order():
    values = np.array([9, 4, 9, 7, 4, 9, 1], np.uint64) << np.uint64(32)
    places, kinds = substrings._classes(values)
    assert places.tolist() == [1, 4, 0, 2, 5]
    assert kinds[0] == kinds[1] != kinds[2] == kinds[3] == kinds[4]
    assert [len(x) for x in substrings._classes(values[:0])] == [0, 0]


@pytest.mark.parametrize("block", [1, 7, 100, 1 << 15])
def test_anchors_do_not_depend_on_blocks(monkeypatch, block):
    monkeypatch.setattr(substrings, "BLOCK", block)
    rnd = random.Random(6)
    sizes = [0, 99, 100, 101, 5, 350, 100]
    texts = [bytes(rnd.choice(b"ab") for _ in range(n)) for n in sizes] + [b"a" * 150]
    text, start, stretch, offset, grams, _ = substrings._anchors(texts)
    place = np.arange(substrings.LENGTH - substrings.GRAM + 1)
    wanted = []
    for i, data in enumerate(texts):
        for p in range(len(data) - substrings.LENGTH + 1):
            string = substrings.Prefixes(np.frombuffer(data[p : p + substrings.LENGTH], np.uint8))
            hashes = substrings._mix(string.of(place, place + substrings.GRAM))
            at = int(np.argmin(hashes >> np.uint64(32)))
            if p and wanted[-1][0] == i and wanted[-1][1] + wanted[-1][3] == p + at:
                wanted[-1][2] += 1
            else:
                wanted.append([i, p, 0, at, hashes[at]])
    assert [list(x) for x in zip(text, start, stretch, offset, grams)] == wanted


def test_bins_count_over_tasks():
    rnd = random.Random(8)
    once = [rnd.randrange(1 << 64) for _ in range(3000)]
    tasks = [np.array([*once[:1000], *[5] * 400], np.uint64), np.array([*once[900:2000], 6], np.uint64), np.array([*once[2000:], 6], np.uint64)]
    rows = pd.concat([b for t in tasks for b in substrings._in_bins(iter([t]))])
    assert rows["held"].str.len().sum() // 8 == 3000 + 100 + 2 + 2  # a hash that a task has often is there twice
    rows = rows.sort_values("bin", kind="stable")
    # rows of a bin may come in several batches
    found = pd.concat(substrings._repeated_grams(rows.iloc[i : i + 7] for i in range(0, len(rows), 7)))
    assert found["bin"].is_unique
    keys = np.frombuffer(b"".join(found["held"]), np.uint64)
    assert sorted(keys.tolist()) == sorted(substrings._key(np.array([*once[900:1000], 5, 6], np.uint64)).tolist())


def test_filter_lets_all_repeated_anchors_through(spark):
    rnd = np.random.default_rng(1)
    grams = rnd.integers(0, 1 << 63, 5000).astype(np.uint64)
    rows = pd.concat(substrings._in_bins(iter([grams[:2000]])))
    words = substrings._gram_filter(substrings._met_per_bin(spark.createDataFrame(rows, substrings._BINNED)))
    found = substrings._in_filter(grams, words)
    assert found[:2000].all() and found[2000:].mean() < 0.5
    empty = substrings._gram_filter(spark.createDataFrame(rows.head(0), substrings._BINNED))
    assert not substrings._in_filter(grams, empty).any()


def test_equal_contexts_meet_over_chunks_and_bins(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HELD_BYTES", 256)
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 1 << 9)
    compare(crossing(spark).repartition(3))


def test_earliest_member_of_a_context_stays():
    def member(context, check, doc, start):
        return (11 * context, context, check, doc, 0, start, 3 * substrings.LENGTH + 5)

    # the same place twice is one; equal halves of unequal digests are not the same context
    rows = [member(1, 1, 9, 0), member(1, 1, 4, 70), member(1, 1, 4, 70), member(1, 2, 2, 0), member(2, 1, 8, 5), member(1, 1, 4, 80)]
    held = [np.array(rows[:2], substrings._MEMBER_KIND), np.array(rows[2:], substrings._MEMBER_KIND)]
    binned = pd.concat([substrings._binned_rows([h]) for h in held]).sort_values("bin", kind="stable")
    found = pd.concat(substrings._first_members(iter([binned])))
    assert sorted(found["gram"].dropna()) == [11, 11, 22]
    gone = found[found["gram"].isna()]
    assert sorted(zip(gone["doc"], gone["start"], gone["end"])) == [(4, 80, 183), (9, 0, 103)]


def test_first_strings_of_parts_meet():
    texts = [b"u" * 40 + b"v" * 61, b"u" * 40 + b"v" * 60 + b"w", b"x" * 40 + b"v" * 61]
    left = np.concatenate([substrings._compare_contexts(rows_of([t], parts=3).assign(doc=i))[1] for i, t in enumerate(texts)])
    assert len(left) == 6 and sorted(set(left["doc"])) == [0, 1, 2]
    binned = substrings._binned_rows([left]).sort_values("bin")
    found = pd.concat(substrings._later_strings(iter([binned])))
    # the first 100 bytes of the second are those of the first, the last 100 of the third differ in the byte before "v"
    assert list(zip(found["doc"], found["start"], found["end"])) == [(1, 0, 100)]
