import random

import numpy as np
import pytest
import sentencepiece

from stockweave.llm import pieces, queries
from tests.llm import cases

MODEL = pieces.load_model(queries.PIECES_MODEL)
VOCABULARY = pieces.Vocabulary(MODEL)
TEXTS = ["", " ", "▁a ▁▁ b", "x\x00y\n\n\t z  ", "漢字😀 é", "   lead", "a" * 700, "\U0001f600" * 3, "The quick  brown\nfox — jumps.", "▁", "\n \n"]


def brute(text):
    """Viterbi over the whole text: every piece at every place."""
    made = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    score = {made.id_to_piece(i): (made.get_score(i), i) for i in range(made.get_piece_size()) if not (made.is_byte(i) or made.is_control(i) or made.is_unknown(i))}
    unknown = min(s for s, _ in score.values()) - 10
    mark = "﷐"  # U+2581 in the text is no space
    written = pieces.SPACE + text.replace(pieces.SPACE, mark).replace(" ", pieces.SPACE) if text else ""
    best, back = [0.0], [None]
    for end in range(1, len(written) + 1):
        options = []
        for start in range(max(0, end - 16), end):
            if (piece := written[start:end]) in score:
                options.append((best[start] + score[piece][0], -start, score[piece][1]))
        if written[end - 1] not in score:
            options.append((best[end - 1] + unknown, 1 - end, -1))
        top = max(options)
        best.append(top[0])
        back.append((-top[1], top[2]))
    ids, end = [], len(written)
    while end:
        start, number = back[end]
        raw = written[start:end].replace(mark, pieces.SPACE).encode()
        ids = ([number] if number >= 0 else [made.piece_to_id(f"<0x{b:02X}>") for b in raw]) + ids
        end = start
    return ids


def sample():
    rnd = random.Random(2)
    letters = "aehnorst etin  \né"
    return TEXTS + ["".join(rnd.choice(letters) for _ in range(rnd.randrange(200))) for _ in range(40)]


def test_ids_match_plain_viterbi():
    for text in sample():
        assert VOCABULARY.encode(text).tolist() == brute(text), text


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_streaming_in_parts(size):
    for text in sample():
        if text and pieces.SPACE not in text:
            written = pieces.SPACE + text.replace(" ", pieces.SPACE)
            parts = [written[i : i + size] for i in range(0, len(written), size)]
            assert [i for ids in VOCABULARY.stream(parts) for i in ids] == brute(text)


def test_commits_before_the_end():
    """Ids leave long before the text ends, and what is held stays small."""
    text = ("the cat sat on a mat " * 2000).replace(" ", pieces.SPACE)
    taken = 0

    def parts():
        nonlocal taken
        for i in range(0, len(text), 50):
            taken += 1
            yield text[i : i + 50]

    stream = VOCABULARY.stream(parts())
    next(stream)
    assert taken < 20


def test_round_trip_and_library_decoding():
    made = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    for text in sample():
        ids = VOCABULARY.encode(text)
        assert VOCABULARY.decode(ids) == text
        if "\x00" not in text:
            assert made.decode(ids.tolist()) == text


def test_memory_of_stretches_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 8)
    own = pieces.Vocabulary(MODEL)
    for text in sample():
        assert own.encode(text).tolist() == VOCABULARY.encode(text).tolist()
        assert len(own.memo) <= 8


def test_rows(spark):
    docs = cases.with_clashes(cases.documents(spark))
    rows = pieces.encode(docs, MODEL).collect()
    wanted = sorted(((r.doc_id, None if r.text is None else brute(r.text)) for r in docs.collect()), key=str)
    assert sorted(((r.doc_id, r.ids) for r in rows), key=str) == wanted
    assert all(r.exact is None if r.ids is None else r.exact and r.n_ids == len(r.ids) for r in rows)
    back = pieces.decode(pieces.encode(docs, MODEL, verify=False), MODEL).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
    assert pieces.encode(cases.empty(docs), MODEL).count() == 0
