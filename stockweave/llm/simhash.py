"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint of 64 bits is cut into 32 segments of two bits, and each segment is
mapped to its number of set bits: a point with 32 coordinates from 0 to 2. The
Manhattan distance of two points never exceeds the number of differing bits, so
pairs at distance 5 and more are out. Coordinates are kept in unary (00, 01, 11),
which makes that distance the popcount of one xor.

Pairs are found by a range join on a grid. The coordinates form three blocks; if
two points are within 4 of each other, they are within 1 of each other in some
block. A cell of the grid is one block's exact coordinates. Every point is at home
in one cell per block and also visits the cells one step up in one coordinate;
two points one step apart meet where the lower one visits. A cell then compares
visitors and residents with residents only: first by Manhattan distance over all
32 coordinates, then exactly.

Only distinct fingerprints take part, so exact copies cost nothing. A cell of many
points is cut into blocks of residents against blocks of visitors. Tasks report
links through a union-find, a spanning forest and never all pairs; a large cell
is walked: a point's neighbours leave the set of points still to be compared, so a
dense group of n points costs about n steps. Components come from
alternating star contractions over the forest, whose tables are written to the
shared folder each round.

Texts: A-Z lower-cased, words, shingles of four words joined by a space, repeats
included; XXH64 with seed 42 per shingle. A bit is set if it is set in over half of the
hashes. Fewer words than four give one shingle; no words, or a null text, the fingerprint
zero, which links like any other. Null keys take part and are never the smallest
key of a component unless it has no other; repeated rows share a component. An
empty table gives no rows; columns other than the key and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import fresh, numbered
from stockweave.session import settle_table

SHINGLE = 4
SEED = 42
DISTANCE = 4
# most residents, and most visitors, that are compared in one go
CELL_ROWS = 8_192
# a cell of more rows is walked instead of paired up
WALK_ROWS = 512
PIECE_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_LOW = np.uint64(0x5555555555555555)
# first segment of each block, and the end
_BLOCKS = (0, 11, 22, 32)
_PAIRS = 1 << 21


def _word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words, a piece of the text at a time."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + PIECE_BYTES)
        end = cut.start() if cut else len(text)
        yield text[at:end].split()
        at = end


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """Hashes of all shingles of `shingle` words, a piece of the text at a time."""
    digest, carry, some = xxhash.xxh64_intdigest, [], False
    for words in _word_pieces(text.lower()):
        words = carry + words
        n = len(words) - shingle + 1
        if n > 0:
            joined = b" ".join(words)
            ends = list(accumulate(len(w) + 1 for w in words))
            spans = zip([0, *ends], ends[shingle - 1 :])
            yield np.fromiter((digest(joined[s : e - 1], SEED) for s, e in spans), np.uint64, n)
            some = True
        carry = words[-(shingle - 1) :]
    if not some and carry:
        yield np.array([digest(b" ".join(carry), SEED)], np.uint64)


def fingerprint(text: str | None) -> int:
    """The fingerprint as an unsigned number."""
    counts, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes((text or "").encode("utf-8", "replace")):
        for part in np.array_split(hashes, -(-len(hashes) // 65_536)):
            bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
            total += len(part)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and fp long (the fingerprint's bits) of every row of `docs` (key, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            fps = np.array([fingerprint(t) for t in rows["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({key: rows[key], "fp": fps})

    return docs.select(key, "text").mapInPandas(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, fp long")


def embed(fps: np.ndarray) -> np.ndarray:
    """Set bits per two-bit segment in unary: 00, 01 or 11."""
    high = fps >> np.uint64(1)
    return (((high & fps) & _LOW) << np.uint64(1)) | ((high | fps) & _LOW)


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every point's home cell and the cells it visits."""
    for rows in batches:
        fps = rows["fp"].to_numpy().view(np.uint64)
        points = embed(fps)
        for block, (first, end) in enumerate(zip(_BLOCKS, _BLOCKS[1:])):
            width = np.uint64(2 * (end - first))
            own = (points >> np.uint64(2 * first)) & ((np.uint64(1) << width) - np.uint64(1))
            tag = np.int64(block) << 24
            yield pd.DataFrame({"cell": (own.astype(np.int64) | tag).astype(np.int32), "home": True, "fp": rows["fp"]})
            for s in range(end - first):
                at = np.uint64(2 * s)
                value = (own >> at) & np.uint64(3)
                step = value < 3
                # 00 -> 01 sets the low bit, 01 -> 11 the high one
                up = own[step] | (np.where(value[step] == 0, np.uint64(1), np.uint64(2)) << at)
                yield pd.DataFrame({"cell": (up.astype(np.int64) | tag).astype(np.int32), "home": False, "fp": rows["fp"][step]})


class _Links:
    """A union-find that keeps the links which join two groups."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}
        self.kept: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        up = self.parent.setdefault(x, x)
        while up != x:
            self.parent[x] = self.parent.setdefault(up, up)
            x, up = up, self.parent[up]
        return x

    def add(self, pairs: np.ndarray) -> None:
        for a, b in pairs.tolist():
            x, y = self.root(a), self.root(b)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                self.kept.append((a, b))

    def take(self) -> pd.DataFrame:
        out = pd.DataFrame(self.kept, columns=["a", "b"], dtype=np.int64)
        self.kept = []
        return out


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs link: the lower bound on the embedding first, then the bits themselves."""
    near = np.flatnonzero(np.bitwise_count(embed(a) ^ embed(b)) <= DISTANCE)
    return near[np.bitwise_count(a[near] ^ b[near]) <= DISTANCE]


def _walk(points: np.ndarray, links: _Links) -> None:
    """Links of one large cell; linked points are not compared again."""
    left = np.unique(points)
    left_points = embed(left)
    while len(left):
        queue, left, left_points = [left[0]], left[1:], left_points[1:]
        while queue and len(left):
            x = queue.pop()
            bound = np.bitwise_count(left_points ^ embed(np.array([x], np.uint64))) <= DISTANCE
            near = bound & (np.bitwise_count(left ^ x) <= DISTANCE)
            if near.any():
                found = left[near]
                pairs = np.stack([np.full(len(found), x).view(np.int64), found.view(np.int64)], axis=1)
                links.add(pairs)
                queue.extend(found)
                left, left_points = left[~near], left_points[~near]


def _pair_up(cells: np.ndarray, home: np.ndarray, fps: np.ndarray, links: _Links) -> None:
    """Links of many small cells; rows are sorted by cell, residents first."""
    start = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    size = np.diff(np.r_[start, len(cells)])
    residents = np.add.reduceat(home.astype(np.int64), start)
    first, n = np.repeat(start, size), np.repeat(residents, size)
    at = np.arange(len(cells))
    begin = np.where(home, at + 1, first)  # a resident meets the residents after it, a visitor all of them
    count = first + n - begin
    done = 0
    while done < len(cells):
        upto = done + max(1, int(np.searchsorted(np.cumsum(count[done:]), _PAIRS)))
        c = count[done:upto]
        left = np.repeat(at[done:upto], c)
        right = np.arange(len(left)) - np.repeat(np.cumsum(c) - c, c) + np.repeat(begin[done:upto], c)
        a, b = fps[left], fps[right]
        keep = _close(a, b)
        keep = keep[a[keep] != b[keep]]
        links.add(np.stack([a[keep].view(np.int64), b[keep].view(np.int64)], axis=1))
        done = upto


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of the cells of one partition, which is sorted by cell."""
    links = _Links()
    held: list[pd.DataFrame] = []

    def settle(rows: pd.DataFrame) -> None:
        key = rows["cell"].to_numpy().astype(np.int64) << 32 | rows["part"].to_numpy().astype(np.int64)
        home, fps = rows["home"].to_numpy(), rows["fp"].to_numpy().view(np.uint64)
        order = np.lexsort((~home, key))
        key, home, fps = key[order], home[order], fps[order]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[start, len(key)])
        residents = np.add.reduceat(home.astype(np.int64), start)
        for s, n in zip(start[size > WALK_ROWS], size[size > WALK_ROWS]):
            _walk(fps[s : s + n], links)
        small = np.repeat((size <= WALK_ROWS) & (residents > 0) & (size > 1), size)
        if small.any():
            _pair_up(key[small], home[small], fps[small], links)

    for rows in batches:
        if not len(rows):
            continue
        last = (rows["cell"].to_numpy() == rows["cell"].iloc[-1]) & (rows["part"].to_numpy() == rows["part"].iloc[-1])
        if last.all() and held and (held[-1]["cell"].iloc[-1], held[-1]["part"].iloc[-1]) == (rows["cell"].iloc[0], rows["part"].iloc[0]):
            held.append(rows)
            continue
        settle_now = pd.concat([*held, rows[~last]]) if held or not last.all() else None
        if settle_now is not None and len(settle_now):
            settle(settle_now)
            yield links.take()
        held = [rows[last]]
    if held:
        settle(pd.concat(held))
        yield links.take()


def link_forest(fps: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fps` (fp) that connect what all links connect."""
    rows = settle_table(fps.select("fp").mapInPandas(_cells, "cell int, home boolean, fp long"), "simhash-cells")
    # large cells only; a table of at most rows / cell_rows cells
    sizes = rows.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > cell_rows)
    large = sizes.select("cell", F.ceil(F.col("n") / F.lit(cell_rows)).cast("int").alias("k"))
    dealt = rows.join(large, "cell", "left").withColumn("k", F.coalesce("k", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
    every = F.sequence(F.lit(0), F.col("k") - 1)
    # block (i, j): residents of slice i against all rows of slice j
    as_resident = F.transform(every, lambda j: F.struct((own * F.col("k") + j).alias("part"), F.lit(True).alias("home")))
    as_visitor = F.transform(every, lambda i: F.struct((i * F.col("k") + own).alias("part"), F.lit(False).alias("home")))
    blocks = F.when(F.col("k") == 1, F.array(F.struct(F.lit(0).alias("part"), F.col("home").alias("home"))))
    blocks = blocks.when(F.col("home"), F.concat(as_resident, as_visitor)).otherwise(as_visitor)
    placed = dealt.select("cell", "fp", F.inline(blocks))
    sorted_cells = placed.repartition("cell", "part").sortWithinPartitions("cell", "part")
    return settle_table(sorted_cells.mapInPandas(_compare, "a long, b long"), "simhash-links")


def star_components(links: DataFrame) -> DataFrame:
    """Node and root (the smallest node) of every node in `links` (a, b), by alternating stars."""
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = settle_table(edges, "star-edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # large star: larger neighbours of a node go to its smallest neighbour
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settle_table(large, "star-large")
        # small star: smaller neighbours, and the node, go to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        edges = settle_table(small.distinct(), "star-edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, fp and component (the smallest key reachable over links) of every row of `docs` (key, text)."""
    marked = settle_table(fingerprints(docs, key), "simhash-fingerprints")
    distinct = settle_table(marked.groupBy("fp").agg(F.min(key).alias("first")), "simhash-distinct")
    roots = star_components(link_forest(distinct))
    linked = roots.join(distinct, roots["node"] == distinct["fp"]).select("fp", "root", "first")
    component = linked.groupBy("root").agg(F.min("first").alias("least"))
    linked = linked.join(component, "root").select("fp", "least")
    classes = distinct.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("component"))
    # written first: the last join then starts from plain tables, and a hot fingerprint can be split
    classes = settle_table(classes, "simhash-classes")
    return marked.join(classes, "fp", "left").select(key, "fp", "component")


def one_of_each(docs: DataFrame, find: Callable[[DataFrame, str], DataFrame] = near_duplicates) -> DataFrame:
    """`docs` (doc_id, text, more) without all but one row of each component of `find`: the smallest doc_id, null last."""
    row = fresh(docs, "row_id")
    rows = numbered(docs, row, "simhash-rows")
    found = find(rows, row).join(rows.select(row, "doc_id"), row)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    kept = found.groupBy("component").agg(F.min(order)[row].alias(row)).select(row)
    # kept rows are a number each, the side to hash; texts are neither sorted nor kept
    return rows.join(kept.hint("shuffle_hash"), row, "left_semi").select(*docs.columns)
