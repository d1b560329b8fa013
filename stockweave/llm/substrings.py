"""Suffix-array removal of repeated 100-byte strings.

A byte goes if a string of `LENGTH` bytes that covers it also starts earlier: in a document
with a smaller id, or in the same document before it.

Which suffixes can share their first `LENGTH` bytes is decided by anchors. The anchor of a
string is its `GRAM`-byte substring of smallest hash, the leftmost of equals; it depends on
the string alone, so equal strings have equal anchors at equal offsets. The starts of
strings that share an anchor form a stretch, and the bytes those strings cover are the
anchor's context. That leaves one row per some thirty bytes instead of one per byte.

1. Anchor hashes that occur once are dropped: every task hands on its hashes sorted, as one array
   per bin of them, the arrays of a bin meet in one task, and a filter of bounded size
   (`FILTER_BITS`) of those that repeat is what the tasks of the next pass look into. Where it is
   too small for the corpus it lets more rows through and changes no result.
2. Equal contexts are classes: all members but the earliest go, over the whole context.
   Members in the same chunk of a task are settled there, each compared byte by byte with the
   first, so that a passage in a third of all documents leaves one row per chunk; the others
   meet by a cryptographic digest of 128 bits, in one task per bin of the digests.
3. Different contexts of one anchor (where copies begin, end or differ) are compared as
   suffixes. Those that have a hash of their first `LENGTH` bytes in common with another one of
   the anchor and offset are merge-sorted by comparisons that find the common extension of two
   suffixes by binary search over prefix polynomial hashes, a logarithmic number of probes,
   and then look at one byte. Neighbours in that order that share `LENGTH` bytes are compared
   byte by byte before the later one goes. Anchors with more than `PART` contexts are dealt
   out by document; the first string of each part then meets the others of its kind, by anchor and
   two independent hashes of its bytes, in one task per bin of the hashes, so no anchor is gathered in one task.

Hashes are H(i) = sum of (byte + 1) * B^j for j < i, modulo 2^64; a substring's is the
difference of two, times a power of the inverse of B. All work is on the input texts; a text is
joined with its removed spans once, at the end.

Null texts are empty. A null doc_id counts as the largest. Rows that repeat a doc_id with the
same text are one document, and each gets its result; with different texts they are
ordered by a checksum of the text. Texts shorter than `LENGTH` are kept; an empty table gives
no rows; columns other than doc_id and text are not read. A text is handled whole, in memory of
some hundred bytes per byte of the longest text of a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import text_of
from stockweave.session import settle_table

LENGTH = 100
GRAM = 32
# filters of repeated anchors: bits per key up to a fixed size of 32 MiB
BITS_PER_KEY = 12
FILTER_BITS = 1 << 28
# hashes of anchors and equal contexts meet in so many bins, a power of two; a task hands on its bins after so many bytes
BINS = 2_048
HELD_BYTES = 8 << 20
# most contexts of an anchor that one task compares
PART = 2_048
CHUNK_BYTES = 2 << 20
# starts whose anchors are found in one go
BLOCK = 1 << 15
# contexts that are compared in one go
SORT_ROWS = 8_192
LAST = (1 << 63) - 1

_BASE = 0x9E3779B97F4A7C15
_M64 = (1 << 64) - 1
# the lower half of a rank is a place: enough for any text
_PLACE = np.uint64((1 << 32) - 1)
_BINNED = "bin int, held binary"
# a key's bin is in its upper bits
_BIN = np.uint64(65 - BINS.bit_length())


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base & _M64, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


class _Powers:
    """Powers of the base and of its inverse, grown as needed."""

    up = down = np.zeros(0, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return cls.up, cls.down


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _key(grams: np.ndarray) -> np.ndarray:
    """Hashes of anchors, one to one, with even upper bits: those of an anchor are small, as it is the smallest."""
    return _mix(grams + np.uint64(_BASE))


class Prefixes:
    """Prefix hashes of a byte array; the hash of any substring in constant time."""

    def __init__(self, data: np.ndarray) -> None:
        self.data = data
        self.up, self.down = _Powers.get(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def common(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """Length of the common extension of the suffixes at `a` and `b`, up to `most`."""
        # equal where the difference of sums, one side times a power of the base, is the one before the suffixes
        power = self.down[a] * self.up[b]
        before = self.sums[a] * power - self.sums[b]
        found = np.full(len(a), most, np.int64)
        differ = np.flatnonzero(self.sums.take(a + most) * power - self.sums.take(b + most) != before)
        a, b, power, before = a[differ], b[differ], power[differ], before[differ]
        low = np.zeros(len(a), np.int64)
        step = 1 << (int(most).bit_length() - 1)
        while step and len(a):
            middle = np.minimum(low + step, most)
            same = self.sums.take(a + middle) * power - self.sums.take(b + middle) == before
            low = np.where(same, middle, low)
            step >>= 1
        found[differ] = low
        return found


def _anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Per anchor of every text: text number, first start, stretch (starts - 1), offset of the anchor, hash; and the bytes' offsets."""
    sizes = np.array([len(t) for t in texts], np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    heads = at[:-1][sizes >= LENGTH]
    if not len(heads):
        return (*[np.zeros(0, np.int64)] * 4, np.zeros(0, np.uint64), at)
    data = np.frombuffer(b"".join(texts), np.uint8)
    blocks = [_block_anchors(data, a, heads) for a in range(0, len(data) - LENGTH + 1, BLOCK)]
    low, held, grams = (np.concatenate(x) for x in zip(*blocks))
    text = np.searchsorted(at, low, "right") - 1
    last = at[text + 1] - LENGTH
    # other strings would run on into the next text
    whole = np.flatnonzero(low <= last)
    text, low, held, grams, last = (x[whole] for x in (text, low, held, grams, last))
    end = np.minimum(np.append(low[1:] - 1, len(data)), last)
    return text, low - at[text], end - low, held - low, grams, at


def _block_anchors(data: np.ndarray, begin: int, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The starts from `begin` on, BLOCK of them, whose anchor is not that of the start before or that are in `heads`;
    the places and hashes of their anchors. A block's arrays stay in a core's cache."""
    before = min(begin, 1)
    part = data[begin - before : begin + BLOCK + LENGTH - 1]
    up, down = _Powers.get(BLOCK + LENGTH)
    values = part.astype(np.uint64)
    values += np.uint64(1)
    values *= up[: len(part)]
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    grams = sums[GRAM:] - sums[:-GRAM]
    grams *= down[: len(grams)]
    grams = _mix(grams)
    # the upper bits of the hash, and the place so that the leftmost of equals is smallest
    least = grams & ~_PLACE
    least |= np.arange(len(grams), dtype=np.uint64)
    # the smallest of two, four, eight ... places, then of all places of a string
    places, width = LENGTH - GRAM + 1, 1
    while 2 * width <= places:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - places + width], least[places - width :])
    new = np.zeros(len(least), bool)
    np.not_equal(least[1:], least[:-1], out=new[1:])
    new[heads[np.searchsorted(heads, begin) : np.searchsorted(heads, begin + BLOCK)] - begin + before] = True
    first = np.flatnonzero(new)
    held = (least[first] & _PLACE).astype(np.int64)
    return first + (begin - before), held + (begin - before), grams[held]


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[bytes]]]:
    """Rows in chunks of some bytes, each whole text with its row."""
    for rows in batches:
        texts = [t.encode("utf-8", "replace") for t in rows["text"]]
        ends = np.cumsum([len(t) for t in texts])
        cut = np.searchsorted(ends // CHUNK_BYTES, np.arange(1, (ends[-1] if len(ends) else 0) // CHUNK_BYTES + 1))
        edges = sorted({0, *cut.tolist(), len(texts)})
        for a, b in zip(edges, edges[1:]):
            yield rows.iloc[a:b], texts[a:b]


def _per_bin(bins: np.ndarray, values: np.ndarray) -> pd.DataFrame:
    """A row per bin of `values`, which are in the order of their `bins`."""
    found, first = np.unique(bins, return_index=True)
    return pd.DataFrame({"bin": found.astype(np.int32), "held": [x.tobytes() for x in np.split(values, first[1:])][: len(found)]})


def _binned(grams: list[np.ndarray]) -> pd.DataFrame:
    """A row per bin of `grams`: their `_key`s, sorted, those that occur more than twice twice."""
    keys = np.sort(_key(np.concatenate(grams)))
    thrice = np.zeros(len(keys), bool)
    thrice[2:] = (keys[2:] == keys[1:-1]) & (keys[2:] == keys[:-2])
    keys = keys[~thrice]
    return _per_bin(keys >> _BIN, keys)


def _in_bins(found: Iterator[np.ndarray | pd.DataFrame], binned=_binned) -> Iterator[pd.DataFrame]:
    """The bins of some arrays at a time; frames are handed on as they are."""
    held: list[np.ndarray] = []
    for values in found:
        if isinstance(values, pd.DataFrame):
            yield values
            continue
        held.append(values)
        if sum(x.nbytes for x in held) >= HELD_BYTES:
            yield binned(held)
            held = []
    if held:
        yield binned(held)


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return _in_bins(_anchors(texts)[4] for _, texts in _chunks(batches))


def _bin_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return _in_bins(rows["gram"].to_numpy(np.int64).view(np.uint64) for rows in batches)


def _each_bin(batches: Iterator[pd.DataFrame], kind) -> Iterator[tuple[int, np.ndarray]]:
    """Bins with all their values, from rows sorted by bin."""
    held: list[bytes] = []
    now = None
    for rows in batches:
        for at, values in zip(rows["bin"].tolist(), rows["held"]):
            if held and at != now:
                yield now, np.frombuffer(b"".join(held), kind)
                held = []
            now = at
            held.append(values)
    if held:
        yield now, np.frombuffer(b"".join(held), kind)


def _repeated_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for at, keys in _each_bin(batches, np.uint64):
        keys = np.sort(keys)
        yield pd.DataFrame({"bin": [at], "held": [np.unique(keys[1:][keys[1:] == keys[:-1]]).tobytes()]})


def _met_per_bin(rows: DataFrame) -> DataFrame:
    """All rows of a bin one after the other in one task; a bin holds a small even share of the hashes."""
    return rows.repartition("bin").sortWithinPartitions("bin")


def _probe_bits(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """Places of a key's bits in its bin, which has so many."""
    return [x % np.uint64(bits) for x in (keys, _mix(keys + np.uint64(_BASE)), _mix(keys ^ np.uint64(_M64 >> 1)))]


def _gram_filter(binned: DataFrame) -> np.ndarray:
    """A filter of the keys in `binned` (bin, held; met per bin), of at most FILTER_BITS bits: a row of words per bin."""
    n = binned.agg(F.sum(F.octet_length("held"))).first()[0] or 0
    words = max(1, min(FILTER_BITS, n // 8 * BITS_PER_KEY) // 64 // BINS)

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for at, keys in _each_bin(batches, np.uint64):
            bits = np.zeros(64 * words, np.uint8)
            bits[np.concatenate(_probe_bits(keys, 64 * words)).astype(np.int64)] = 1
            yield pd.DataFrame({"bin": [at], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    out = np.zeros((BINS, words), np.uint64)
    for at, bits in binned.mapInPandas(own, "bin int, bits binary").toPandas().itertuples(index=False):
        out[at] |= np.frombuffer(bits, "<u8")
    return out


def _in_filter(grams: np.ndarray, words: np.ndarray) -> np.ndarray:
    keys = _key(grams)
    first = (keys >> _BIN) * np.uint64(words.shape[1])
    found = np.ones(len(keys), bool)
    for at in _probe_bits(keys, 64 * words.shape[1]):
        found &= (words.ravel()[first + (at >> np.uint64(6))] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return found


# contexts in a bin: each its anchor's hash, the halves of a digest of its bytes, and stretch * LENGTH + offset of the
# anchor, which follow from the bytes, and its place; or, without a bin, a span that goes
_MEMBER = f"{_BINNED}, doc long, tie int, start int, end int"
_MEMBER_KIND = np.dtype([("gram", "<i8"), ("context", "<i8"), ("check", "<i8"), ("doc", "<i8"), ("tie", "<i4"), ("start", "<i4"), ("shape", "<i4")])
# the anchor of a class of equal contexts, or a span that goes
_CLASS = "gram long, doc long, tie int, start int, end int"
# strings in a bin: each its anchor's hash, two hashes of its bytes, and its place
_STRING_KIND = np.dtype([("gram", "<i8"), ("string", "<i8"), ("check", "<i8"), ("doc", "<i8"), ("tie", "<i4"), ("start", "<i4")])
_CONTEXT = "gram long, shape int, doc long, tie int, start int, bytes binary"


def _digests(contexts: list[bytes]) -> np.ndarray:
    """The two halves of each context's digest."""
    whole = b"".join([hashlib.blake2b(c, digest_size=16).digest() for c in contexts])
    return np.frombuffer(whole, np.int64).reshape(-1, 2)


def _earliest(found, kind: tuple[str, ...] = ("context", "check")) -> tuple[np.ndarray, ...]:
    """The order by kind and place, and in it: whether a row's kind is that of the row before,
    the first row of the kind, and whether that is another place, so that the row's goes."""
    order = np.lexsort([found[c] for c in ("start", "tie", "doc", *kind)])
    kinds = [np.asarray(found[c])[order] for c in kind]
    place = [np.asarray(found[c])[order] for c in ("doc", "tie", "start")]
    same = np.zeros(len(order), bool)
    same[1:] = np.logical_and.reduce([x[1:] == x[:-1] for x in kinds])
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    # of rows that give a document twice none is the earlier one
    later = same & np.logical_or.reduce([x != x[first] for x in place])
    return order, same, first, later


def _binned_rows(held: list[np.ndarray]) -> pd.DataFrame:
    """A row per bin of contexts or strings; a bin is a small even share of their digests or hashes, the second field."""
    rows = np.concatenate(held)
    bins = rows[rows.dtype.names[1]].view(np.uint64) >> _BIN
    order = np.argsort(bins, kind="stable")
    return _per_bin(bins[order], rows[order]).assign(doc=None, tie=None, start=None, end=None)


def _first_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per class of equal contexts its anchor's hash, and the spans of all but the earliest."""
    for _, rows in _each_bin(batches, _MEMBER_KIND):
        order, same, _, later = _earliest(rows)
        rows = rows[order]
        yield pd.DataFrame({"gram": rows["gram"][~same]}).assign(doc=None, tie=None, start=None, end=None)
        gone = rows[later]
        end = gone["start"] + gone["shape"] // LENGTH + LENGTH
        yield pd.DataFrame({"doc": gone["doc"], "tie": gone["tie"], "start": gone["start"], "end": end}).assign(gram=None)


def _members(words: np.ndarray, with_bytes: bool):
    """Contexts whose anchor is in the filter; of equal ones in a chunk the earliest, and the spans of the others."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame | np.ndarray]:
        for rows, texts in _chunks(batches):
            text, start, stretch, offset, grams, _ = _anchors(texts)
            kept = np.flatnonzero(_in_filter(grams, words))
            text, start, stretch, offset, grams = (x[kept] for x in (text, start, stretch, offset, grams))
            ends = start + stretch + LENGTH
            contexts = [texts[t][s:e] for t, s, e in zip(text.tolist(), start.tolist(), ends.tolist())]
            halves = _digests(contexts)
            found = pd.DataFrame(
                {
                    "gram": grams.view(np.int64),
                    "context": halves[:, 0],
                    "check": halves[:, 1],
                    "shape": (stretch * LENGTH + offset).astype(np.int32),
                    "doc": rows["doc"].to_numpy()[text],
                    "tie": rows["tie"].to_numpy()[text],
                    "start": start.astype(np.int32),
                    "end": ends.astype(np.int32),
                }
            )
            order, same, first, later = _earliest(found)
            found = found.iloc[order]
            if any(contexts[i] != contexts[j] for i, j in zip(order[same].tolist(), order[first[same]].tolist())):
                raise ArithmeticError("two different contexts have equal digests; use another digest")
            if with_bytes:
                found["bytes"] = [contexts[i] for i in order]
                yield found.drop(columns=["context", "check", "end"])[~same]
            else:
                yield _joined(found[later])
                yield found[list(_MEMBER_KIND.names)][~same].to_records(index=False).astype(_MEMBER_KIND)

    return run if with_bytes else lambda batches: _in_bins(run(batches), _binned_rows)


def _joined(spans: pd.DataFrame) -> pd.DataFrame:
    """Spans (doc, tie, start, end) of which those that overlap or touch are one; no other columns are set."""
    spans = spans.sort_values(["doc", "tie", "start"], kind="stable")
    doc, tie, start, end = (spans[c].to_numpy() for c in ("doc", "tie", "start", "end"))
    if not len(spans):
        return spans[["doc", "tie", "start", "end"]].assign(bin=None, held=None)
    same = (doc[1:] == doc[:-1]) & (tie[1:] == tie[:-1])
    # contexts of a text end in the order they start
    first = np.flatnonzero(np.r_[True, ~(same & (start[1:] <= end[:-1]))])
    last = np.append(first[1:], len(spans)) - 1
    out = pd.DataFrame({"doc": doc[first], "tie": tie[first], "start": start[first], "end": end[last]})
    return out.assign(bin=None, held=None)


def _later_strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The strings of anchors in several parts that another part has earlier."""
    for _, rows in _each_bin(batches, _STRING_KIND):
        order, _, _, later = _earliest(rows, ("gram", "string", "check"))
        gone = rows[order][later]
        yield pd.DataFrame({"doc": gone["doc"], "tie": gone["tie"], "start": gone["start"], "end": gone["start"] + LENGTH})


def _less(prefixes: Prefixes, where: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether suffix a comes before suffix b; equal ones by number, which follows their order in the corpus."""
    shared = prefixes.common(where[a], where[b], LENGTH)
    differ = shared < LENGTH
    step = np.where(differ, shared, 0)
    x, y = prefixes.data[where[a] + step], prefixes.data[where[b] + step]
    return np.where(differ, x < y, a < b)


def merge_sort(prefixes: Prefixes, where: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Suffix numbers sorted within their buckets, which are contiguous.

    Runs of all buckets double together. An element's place in a merged run is its place
    in its own run plus the number of smaller elements in the other, found by binary search.
    A bucket that is in order, as each element is compared with the one before, is one run.
    """
    order = np.arange(len(where))
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    size = np.diff(np.r_[first, len(where)])
    at, n = np.repeat(first, size), np.repeat(size, size)
    inner = np.flatnonzero(bucket[1:] == bucket[:-1])
    unsorted = np.zeros(len(where), bool)
    unsorted[at[inner[_less(prefixes, where, inner + 1, inner)]]] = True
    live = np.flatnonzero(unsorted[at])
    run = 1
    while len(live):
        local = live - at[live]
        left = (local // run) % 2 == 0
        own = local - local % (2 * run)  # where the merged run starts
        middle = np.minimum(own + run, n[live])
        end = np.minimum(own + 2 * run, n[live])
        low = at[live] + np.where(left, middle, own)
        high = at[live] + np.where(left, end, middle)
        begin = low.copy()
        me = order[live]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            probe = (low[open_] + high[open_]) >> 1
            smaller = _less(prefixes, where, order[probe], me[open_])
            low[open_] = np.where(smaller, probe + 1, low[open_])
            high[open_] = np.where(smaller, high[open_], probe)
        place = at[live] + np.where(left, local, local - (middle - own)) + (low - begin)
        order[place] = me
        run *= 2
        live = live[n[live] > run]
    return order


def _equal_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the strings at a and b are equal, byte by byte; runs of neighbours are read once."""
    out = np.zeros(len(a), bool)
    chain = np.zeros(len(a), bool)
    chain[1:] = (a[1:] == a[:-1] + 1) & (b[1:] == b[:-1] + 1)
    whole = np.flatnonzero(~chain)
    span = np.arange(LENGTH)
    for part in np.array_split(whole, -(-len(whole) // 20_000) or 1):
        out[part] = (data[a[part][:, None] + span] == data[b[part][:, None] + span]).all(axis=1)
    # in a run, the string before was equal or not; only its last byte is new
    last = data[a + LENGTH - 1] == data[b + LENGTH - 1]
    broken = np.flatnonzero(chain & ~last)
    if len(broken) or not out[whole].all():
        rest = np.flatnonzero(chain)
        for part in np.array_split(rest, -(-len(rest) // 20_000) or 1):
            out[part] = (data[a[part][:, None] + span] == data[b[part][:, None] + span]).all(axis=1)
    else:
        out[chain] = True
    return out


def _weighted(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A second hash of the strings at `start`: their words of four bytes, each times a weight of its own."""
    weights = _mix(np.arange(1, LENGTH // 4 + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    out = np.zeros(len(start), np.uint64)
    span = np.arange(LENGTH)
    for part in np.array_split(np.arange(len(start)), -(-len(start) // 20_000) or 1):
        words = data[start[part][:, None] + span].view(np.uint32)
        out[part] = _mix((words * weights).sum(axis=1, dtype=np.uint64))
    return out.view(np.int64)


def _classes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the values that occur more than once, equal ones in a row and in order, and the class of each.

    A class is told by the upper bits of a value only, so unlike ones may share it."""
    bits = np.uint64(len(values).bit_length())
    order = np.sort(values >> bits << bits | np.arange(len(values), dtype=np.uint64))
    kind = order >> bits
    same = np.zeros(len(values) + 1, bool)
    np.equal(kind[1:], kind[:-1], out=same[1:-1])
    met = np.flatnonzero(same[1:] | same[:-1])
    kind = kind[met]
    return (order[met] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), kind


def _compare_contexts(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """For the contexts of whole (gram, part) groups: spans of strings that start earlier, and what
    is left of the strings of anchors in several parts, one by one."""
    rows = rows.drop_duplicates(["gram", "doc", "tie", "start"])
    rows = rows.sort_values(["doc", "tie", "start"], kind="stable").reset_index(drop=True)
    data = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
    size = rows["bytes"].str.len().to_numpy(np.int64)
    at = np.cumsum(size) - size
    n = rows["shape"].to_numpy(np.int64) // LENGTH + 1
    context = np.repeat(np.arange(len(rows)), n)
    step = np.arange(len(context)) - np.repeat(np.cumsum(n) - n, n)
    offset = rows["shape"].to_numpy(np.int64) % LENGTH
    # strings can only be equal where the anchor is at the same offset and their hashes are equal: one whose hash
    # none of these has equals none and is left out of the sort
    group = _mix(_mix(rows["gram"].to_numpy(np.int64).view(np.uint64)) + rows["part"].to_numpy(np.uint64)) + offset.astype(np.uint64)
    place = np.repeat(at, n) + step
    prefixes = Prefixes(data)
    hashes = _mix(prefixes.of(place, place + LENGTH) + _mix(np.repeat(group, n) - step.astype(np.uint64)))
    meets, bucket = _classes(hashes)
    where = place[meets]
    order = merge_sort(prefixes, where, bucket)
    later, earlier = order[1:], order[:-1]
    same = np.flatnonzero(bucket[later] == bucket[earlier])
    a, b = where[later[same]], where[earlier[same]]
    shared = prefixes.common(a, b, LENGTH) == LENGTH
    same, a, b = same[shared], a[shared], b[shared]
    chained = np.argsort(a)  # strings of one context one after the other; each is in one pair as the later one
    sure = np.zeros(len(a), bool)
    sure[chained] = _equal_bytes(data, a[chained], b[chained])
    if not sure.all():
        raise ArithmeticError("two different strings have equal hashes; use another base")
    lost = np.zeros(len(place), bool)
    lost[meets[later[same]]] = True
    begin = rows["start"].to_numpy()[context] + step

    gone = np.flatnonzero(lost)
    new = np.ones(len(gone), bool)
    new[1:] = (gone[1:] != gone[:-1] + 1) | (context[gone[1:]] != context[gone[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(gone)) - 1 if len(gone) else first
    doc, tie = (rows[c].to_numpy()[context[gone[first]]] for c in ("doc", "tie"))
    spans = pd.DataFrame({"doc": doc, "tie": tie, "start": begin[gone[first]], "end": begin[gone[last]] + LENGTH}).assign(bin=None, held=None)
    open_ = np.flatnonzero(~lost & (rows["parts"].to_numpy()[context] > 1))
    left = np.empty(len(open_), _STRING_KIND)
    for c in ("gram", "doc", "tie"):
        left[c] = rows[c].to_numpy()[context[open_]]
    left["string"] = _mix(prefixes.of(place[open_], place[open_] + LENGTH)).view(np.int64)
    left["check"], left["start"] = _weighted(data, place[open_]), begin[open_]
    return spans, left


def _sort_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spans that go, and bins of the first strings of the anchors in several parts; input sorted by gram and part."""
    return _in_bins((x for rows in _whole_groups(batches) for x in _compare_contexts(rows)), _binned_rows)


def _whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of whole groups by gram and part, some thousand at a time."""
    held: list[pd.DataFrame] = []

    for rows in batches:
        if not len(rows):
            continue
        for at in range(0, len(rows), SORT_ROWS):  # groups are whole, and few at a time
            held.append(rows.iloc[at : at + SORT_ROWS])
            if sum(map(len, held)) < SORT_ROWS:
                continue
            some = pd.concat(held, ignore_index=True)
            key = some[["gram", "part"]].to_numpy()
            open_ = (key == key[-1]).all(axis=1)
            held = [some[open_]]
            if not open_.all():
                yield some[~open_]
    if held:
        yield pd.concat(held, ignore_index=True)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc, tie and s, e (a span to remove; spans may overlap) for `docs` (doc, tie, text)."""
    counts = _met_per_bin(docs.select("text").mapInPandas(_count_grams, _BINNED))
    repeated = settle_table(counts.mapInPandas(_repeated_grams, _BINNED), "substring-grams")
    members = settle_table(docs.mapInPandas(_members(_gram_filter(repeated), False), _MEMBER), "substring-members")
    settled, open_ = members.filter("bin IS NULL"), members.filter("bin IS NOT NULL").select("bin", "held")

    # classes of equal contexts: the earliest member stays
    classes = settle_table(_met_per_bin(open_).mapInPandas(_first_members, _CLASS), "substring-classes")
    later = classes.filter("gram IS NULL")

    # anchors with several contexts: compared as suffixes
    several = classes.filter("gram IS NOT NULL").groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1")
    several = settle_table(several.select("gram", F.ceil(F.col("n") / PART).cast("int").alias("parts")), "substring-several")
    wanted = settle_table(_met_per_bin(several.select("gram").mapInPandas(_bin_grams, _BINNED)), "substring-wanted")
    contexts = docs.mapInPandas(_members(_gram_filter(wanted), True), _CONTEXT)
    dealt = contexts.join(several, "gram").withColumn("part", F.pmod(F.xxhash64("doc", "tie"), F.col("parts")).cast("int"))
    strings = dealt.repartition("gram", "part").sortWithinPartitions("gram", "part").mapInPandas(_sort_parts, _MEMBER)
    strings = settle_table(strings, "substring-strings")
    # firsts of the parts of one anchor meet per string
    firsts = _met_per_bin(strings.filter("bin IS NOT NULL").select("bin", "held"))
    crossing = firsts.mapInPandas(_later_strings, "doc long, tie int, start int, end int")
    place = ("doc", "tie", "start", "end")
    spans = settled.select(*place).unionByName(later.select(*place)).unionByName(strings.filter("bin IS NULL").select(*place))
    return spans.unionByName(crossing).select("doc", "tie", F.col("start").alias("s"), F.col("end").alias("e"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans and kept (the remaining bytes) of every row of `docs`."""
    rows = docs.select("doc_id", text_of().alias("text"))
    keyed = rows.select("doc_id", F.coalesce(F.col("doc_id"), F.lit(LAST)).alias("doc"), (F.crc32(F.col("text").cast("binary")) - (1 << 31)).cast("int").alias("tie"), "text")
    spans = repeated_spans(keyed.select("doc", "tie", "text"))
    per_doc = spans.groupBy("doc", "tie").agg(F.collect_set(F.struct("s", "e")).alias("spans"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = []
            for doc_id, text, found in zip(part["doc_id"], part["text"], part["spans"]):
                data = text.encode("utf-8", "replace")
                merged = _merged([(x["s"], x["e"]) for x in found]) if found is not None else []
                edges = [0, *[x for span in merged for x in span], len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((doc_id, len(data), len(data) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), [{"s": s, "e": e} for s, e in merged], kept))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<s:int,e:int>>, kept binary"
    # spans are a short row per document; texts are neither sorted nor kept
    joined = keyed.join(per_doc.hint("shuffle_hash"), ["doc", "tie"], "left")
    return joined.select("doc_id", "text", "spans").mapInPandas(cut, schema)
