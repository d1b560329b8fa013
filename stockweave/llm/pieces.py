"""SentencePiece encoding and decoding by a streaming Viterbi search.

A text is cut into pieces of a given vocabulary so that the sum of the pieces' scores
is largest; among equal sums the longest last piece wins. An automaton reports the pieces
that end at each character, and each position keeps its best sum and the start of
its best piece. Only the last positions, as many as the longest piece has
characters, can still be continued. Their backpointer paths are followed back until
they meet in one boundary; whatever lies before it is final, its ids are committed and
its positions forgotten. Memory is bounded by the distance of such meetings, not by the
text.

Where no piece of the vocabulary can cross, paths always meet: before a run of
spaces in a vocabulary whose pieces have spaces only in front, and around characters that
are in no longer piece. The stretches between such places are streams of their own; ids of
short ones are remembered per Python worker, up to `REMEMBERED`, as words repeat.

The text is taken as it is (identity normalisation, one space put in front, spaces written
as U+2581). Characters outside the vocabulary, and U+2581 itself, become byte pieces, so
that decoding gives back every text exactly. A null text has null ids; an empty one
none. Repeated rows are encoded each; an empty table gives no rows.

The vocabulary file is read on the driver and, being bounded by `MAX_MODEL_BYTES`, sent along.
"""

from __future__ import annotations

import heapq
import re
import sys
import types
from collections.abc import Iterable, Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
MAX_MODEL_BYTES = 32 << 20
REMEMBERED = 1 << 18
LONGEST_REMEMBERED = 64
# an unknown character costs so much more than the worst piece (fixed value of the format)
UNKNOWN_PENALTY = 10.0
# characters between two looks for a meeting of paths
LOOK = 256
BATCH_ROWS = 512


class Vocabulary:
    """Pieces, scores and byte pieces of a model."""

    def __init__(self, model: bytes) -> None:
        made = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_of: list[bytes] = []
        self.byte_ids = np.zeros(256, np.int32)
        self.automaton = ahocorasick.Automaton()
        self.longest, crossing, inside, least = 1, False, set(), 0.0
        self.singles: set[str] = set()
        for i in range(made.get_piece_size()):
            piece = made.id_to_piece(i)
            if made.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif made.is_control(i) or made.is_unknown(i) or made.is_unused(i):
                self.bytes_of.append(b"")
            else:
                score = made.get_score(i)
                self.automaton.add_word(piece, (len(piece), score, i))
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
                self.longest, least = max(self.longest, len(piece)), min(least, score)
                crossing |= SPACE in piece.lstrip(SPACE)
                if len(piece) > 1:
                    inside |= set(piece)
                else:
                    self.singles.add(piece)
        self.automaton.make_automaton()
        self.unknown = least - UNKNOWN_PENALTY
        # stretches that no piece reaches across: spaces and what follows them, and lone line ends
        alone = "" if "\n" in inside else "\n"
        stretches = f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|{alone}" if alone else "")
        self.units = None if crossing else re.compile(stretches)
        self.memo = _Memo(self)

    def stream(self, parts: Iterable[str]) -> Iterator[list[int]]:
        """Ids of the joined parts, committed as soon as no continuation can change them."""
        held = ""  # the text since the last commit
        best, back, by = [0.0], [0], [-1]
        for part in parts:
            for i in range(0, len(part), LOOK):
                # more text follows: what it cannot change any more is final
                cut = self._meeting(back) if held else 0
                if cut:
                    yield self._path(held, back, by, cut)
                    held = held[cut:]
                    top = best[cut]
                    best = [x - top for x in best[cut:]]
                    back = [0] + [x - cut for x in back[cut + 1 :]]
                    by = [-1] + by[cut + 1 :]
                held += part[i : i + LOOK]
                self._extend(held, best, back, by)
        # nothing follows: the path to the end alone survives
        if held:
            yield self._path(held, back, by, len(held))

    def _extend(self, held: str, best: list[float], back: list[int], by: list[int]) -> None:
        """Best sums for the positions of `held` that have none yet."""
        done = len(best) - 1
        new = len(held) - done
        best += [-float("inf")] * new
        back += [0] * new
        by += [-1] * new
        # pieces that end in the new part can start so far before it
        origin = max(0, done - self.longest + 1)
        # positions after characters that are no piece; a byte piece may end there
        foreign = [] if self.singles.issuperset(held[done:]) else [i for i in range(done, len(held)) if held[i] not in self.singles]
        foreign.reverse()

        def close(upto: int) -> None:
            while foreign and foreign[-1] < upto:
                i = foreign.pop()
                if best[i] + self.unknown > best[i + 1]:
                    best[i + 1], back[i + 1], by[i + 1] = best[i] + self.unknown, i, -1

        # by ascending end, of equal ends the longest first
        for end, (length, score, number) in self.automaton.iter(held[origin:] if origin else held):
            at = origin + end + 1
            if at <= done:
                continue
            if foreign and foreign[-1] < at - 1:
                close(at - 1)
            total = best[at - length] + score
            if total > best[at]:
                best[at], back[at], by[at] = total, at - length, number
        close(len(held))

    def _meeting(self, back: list[int]) -> int:
        """The last boundary on the paths of all positions that can still be continued."""
        last = len(back) - 1
        live = [-p for p in range(max(0, last - self.longest + 1), last + 1)]
        heapq.heapify(live)
        at = set(live)
        while len(at) > 1:
            p = -heapq.heappop(live)
            at.discard(-p)
            if -back[p] not in at:
                at.add(-back[p])
                heapq.heappush(live, -back[p])
        return -at.pop()

    def _path(self, held: str, back: list[int], by: list[int], end: int) -> list[int]:
        ids: list[int] = []
        while end:
            start, piece = back[end], by[end]
            if piece >= 0:
                ids.append(piece)
            else:
                ids += self.byte_ids[list(held[start:end].encode())].tolist()[::-1]
            end = start
        return ids[::-1]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        if not text:
            return np.zeros(0, np.int32)
        out = []
        # U+2581 in the text itself is no space: its bytes stand between two searches
        for i, part in enumerate(text.split(SPACE)):
            if i:
                out.append(self.byte_ids[list(SPACE.encode())].tobytes())
            written = (SPACE if not i else "") + part.replace(" ", SPACE)
            if self.units is None:
                out += [np.array(ids, np.int32).tobytes() for ids in self.stream([written])]
            else:
                memo = self.memo
                out += [memo[unit] for unit in self.units.findall(written)]
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of `ids`; the space in front is dropped."""
        table = self.bytes_of
        text = b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class _Memo(dict):
    """Ids of stretches, as bytes; emptied when full."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, unit: str) -> bytes:
        ids = np.array([i for part in self.vocabulary.stream([unit]) for i in part], np.int32).tobytes()
        if len(unit) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[unit] = ids
        return ids


def _vocabulary(model: bytes) -> Vocabulary:
    """One per Python worker: a module of its own outlives the task that made it."""
    state = sys.modules.setdefault("_pieces_of_worker", types.ModuleType("_pieces_of_worker"))
    held = getattr(state, "held", None)
    if held is None or held[0] != model:
        held = state.held = (model, Vocabulary(model))
    return held[1]


def load_model(path: str) -> bytes:
    with open(path, "rb") as file:
        model = file.read(MAX_MODEL_BYTES + 1)
    if len(model) > MAX_MODEL_BYTES:
        raise ValueError("the model is larger than MAX_MODEL_BYTES")
    return model


def _lists(parts: list[np.ndarray | None]) -> pa.Array:
    offsets = np.array([0, *accumulate(0 if p is None else len(p) for p in parts)], np.int32)
    flat = np.concatenate([p for p in parts if p is not None] or [np.zeros(0, np.int32)])
    mask = pa.array([p is None for p in parts])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=mask)


def encode(docs: DataFrame, model: bytes, key: str = "doc_id", ids: str = "ids", verify: bool = True) -> DataFrame:
    """key, `ids` array<int>, n_ids and, with `verify`, exact: whether decoding gives the text back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                rows = batch.slice(at, BATCH_ROWS)
                texts = rows.column(1).to_pylist()
                found = [None if t is None else vocabulary.encode(t) for t in texts]
                columns = [rows.column(0), _lists(found), pa.array([None if f is None else len(f) for f in found], pa.int64())]
                if verify:
                    columns.append(pa.array([None if f is None else vocabulary.decode(f) == t for f, t in zip(found, texts)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=[key, ids, "n_ids", "exact"][: len(columns)])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, `{ids}` array<int>, n_ids long" + (", exact boolean" if verify else "")
    return docs.select(key, F.col("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: bytes, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key and text of every row of `encoded` (key, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model)
        for rows in batches:
            texts = [None if x is None else vocabulary.decode(np.array(x, np.int32)) for x in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return encoded.select(key, ids).mapInArrow(run, f"`{key}` {encoded.schema[key].dataType.simpleString()}, text string")
