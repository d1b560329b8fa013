"""Product codes of vectors, trained with norm-of-sum bounds.

A vector of integers is cut into parts; each part position has a codebook, and a vector's
code names the nearest entry of each. Training alternates assignment and means. Entries
are kept in groups, and a part of a row keeps, per group, a lower bound of its distance to the
group's entries (its own one left out) with the round in which the bound was taken, its
stamp. The codebooks of all rounds are retained, so in a later round a bound falls by how
far the group's entries truly moved since the stamp, the norm of the summed
displacements, which is never more than the sum of the norms of each round. A group whose
bound exceeds the distance to the own entry is passed over; the others are rescanned
exactly, in integers, and get a new bound and stamp.

The state of a row (code, bounds, stamps) lies next to its vector and is written to the
shared folder once a round. A round's sums are combined per task and then per part, entry and position:
`parts * entries * width` numbers, all that reaches the driver. Codebooks of all rounds travel with the
tasks: rounds * entries * dimension numbers, whatever the number of rows.

Vectors that are null or hold a null or non-finite component are dropped. Parts are as equal as the
dimension allows. The dimension is that of the first row in the order of vec_id (null last)
and vector; a row of another length keeps its row with a null code and error.
Equal distances go to the lower index. Fewer rows than entries give smaller codebooks.
Repeated rows count each. A null label is a label. No usable row gives no rows. Squared
distances must fit in a long; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.session import settle_table

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
# entries that share a bound
GROUP = 8
_FAR = np.int64(2**62)


@dataclass(frozen=True)
class Codebooks:
    """Entries of every part: arrays (entries, width)."""

    parts: tuple[np.ndarray, ...]

    @property
    def dimension(self) -> int:
        return sum(p.shape[1] for p in self.parts)

    def digest(self) -> str:
        numbers = ",".join(str(x) for part in self.parts for entry in part.tolist() for x in entry)
        return hashlib.sha256(numbers.encode()).hexdigest()


def part_limits(dimension: int, parts: int) -> list[int]:
    return [i * dimension // parts for i in range(parts + 1)]


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """From the first rows in the order of vec_id; None where there are none."""
    order = [F.asc_nulls_last("vec_id"), "v"]
    first = rows.orderBy(*order).select(F.size("v").alias("n")).limit(1).collect()
    if not first:
        return None
    found = rows.filter(F.size("v") == first[0]["n"]).orderBy(*order).select("v").limit(entries).collect()
    table = np.array([r["v"] for r in found], np.int64).reshape(len(found), -1)
    limits = part_limits(table.shape[1], parts)
    return Codebooks(tuple(table[:, a:b] for a, b in zip(limits, limits[1:])))


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and v array<long> of every usable row."""
    big = F.lit(float("inf"))
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.coalesce(usable, F.lit(False)))
    return rows.select("vec_id", "label", F.transform("embedding", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def _root_below(square: np.ndarray) -> np.ndarray:
    """Largest whole number whose square is no larger."""
    root = np.sqrt(square.astype(np.float64)).astype(np.int64)
    root -= root * root > square
    return root


def _squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of `x` to all entries."""
    total = np.zeros((len(x), len(entries)), np.int64)
    for d in range(x.shape[1]):
        gap = x[:, d, None] - entries[None, :, d]
        total += gap * gap
    return total


def _moved(then: np.ndarray, now: np.ndarray, group: int) -> np.ndarray:
    """How far the entries of each group have truly moved at most, rounded up."""
    gone = np.sqrt(((now - then).astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-12)
    return np.maximum.reduceat(gone, np.arange(0, len(gone), group))


class PartAssigner:
    """Nearest entries of one part position over the rounds `history`; counts the distances it takes."""

    def __init__(self, history: list[np.ndarray], group: int = GROUP) -> None:
        self.now = history[-1]
        self.round = len(history) - 1
        self.group = group
        self.starts = np.arange(0, len(self.now), group)
        self.moved = np.stack([_moved(then, self.now, group) for then in history])  # by stamp and group
        self.taken = 0

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Code, bounds, stamps and squared distance of rows without a state."""
        n = len(x)
        code, bound = np.zeros(n, np.int64), np.zeros((n, len(self.starts)), np.int64)
        own = _squared(x, self.now[:1])[:, 0]
        return self._scan(x, code, own, bound, np.zeros_like(bound), np.ones(bound.shape, bool), None)

    def next(self, x: np.ndarray, code: np.ndarray, bound: np.ndarray, stamp: np.ndarray):
        """The same, from the state of the round before."""
        gap = x - self.now[code]
        own = (gap * gap).sum(axis=1)
        self.taken += len(x)
        # what is left of each bound after the move since its stamp
        left = bound - self.moved[stamp, np.arange(len(self.starts))[None, :]] * 1.0 - 1e-9
        need = left <= (np.sqrt(own.astype(np.float64)) * (1 + 1e-12))[:, None]
        return self._scan(x, code, own, bound.copy(), stamp.copy(), need, left)

    def _scan(self, x, code, own, bound, stamp, need, left):
        best, nearest, before = own.copy(), code.copy(), own
        scanned: list[tuple[int, np.ndarray, np.ndarray]] = []
        for g, start in enumerate(self.starts):
            rows = np.flatnonzero(need[:, g])
            if not len(rows):
                continue
            squares = _squared(x[rows], self.now[start : start + self.group])
            self.taken += squares.size
            at = squares.argmin(axis=1)
            value, index = squares[np.arange(len(rows)), at], at + start
            better = (value < best[rows]) | ((value == best[rows]) & (index < nearest[rows]))
            best[rows[better]], nearest[rows[better]] = value[better], index[better]
            scanned.append((g, rows, squares))
        for g, rows, squares in scanned:
            own_here = nearest[rows] // self.group == g
            squares[own_here, nearest[rows][own_here] - self.starts[g]] = _FAR
            bound[rows, g], stamp[rows, g] = _root_below(squares.min(axis=1)), self.round
        if left is not None:
            # the entry that was the own one joins the others of its group
            home = code // self.group
            rows = np.flatnonzero((nearest != code) & ~need[np.arange(len(x)), home])
            kept = np.floor(np.minimum(left[rows, home[rows]], np.sqrt(before[rows].astype(np.float64)) * (1 - 1e-12) - 1e-9))
            bound[rows, home[rows]], stamp[rows, home[rows]] = kept.astype(np.int64), self.round
        return nearest, bound, stamp, best


_STATE = "v array<long>, code array<int>, bound array<long>, stamp array<int>, error long"


def _matrix(column: pa.Array, n: int, kind=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(n, -1)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), kind))


def assign(rows: DataFrame, history: list[Codebooks], group: int = GROUP) -> DataFrame:
    """`rows` (vec_id, label, v, and the state after the first round) with the state of this round.

    Vectors must have the codebooks' dimension.
    """
    number = len(history[-1].parts)
    limits = np.cumsum([0, *[p.shape[1] for p in history[-1].parts]])
    names = ["vec_id", "label", "v", "code", "bound", "stamp", "error"]
    again = "code" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigners = [PartAssigner([h.parts[p] for h in history], group) for p in range(number)]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column("v"), n)
            if again:
                code, bound, stamp = (_matrix(batch.column(c), n).reshape(n, number, -1) for c in ("code", "bound", "stamp"))
            out = []
            for p, part in enumerate(assigners):
                mine = x[:, limits[p] : limits[p + 1]]
                out.append(part.next(mine, code[:, p, 0], bound[:, p], stamp[:, p]) if again else part.first(mine))
            codes = np.stack([o[0] for o in out], axis=1)
            bounds, stamps = (np.stack([o[k] for o in out], axis=1).reshape(n, -1) for k in (1, 2))
            error = np.sum([o[3] for o in out], axis=0)
            state = [_lists(codes, pa.int32()), _lists(bounds, pa.int64()), _lists(stamps, pa.int32()), pa.array(error)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names[:3]] + state, names)

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    return rows.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, {_STATE}")


def _sums(state: DataFrame, books: Codebooks) -> DataFrame:
    """part, entry, position, n and total over all rows, combined per task first."""
    sizes = [p.shape for p in books.parts]
    limits = np.cumsum([0, *[width for _, width in sizes]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(entries, np.int64) for entries, _ in sizes]
        totals = [np.zeros(size, np.int64) for size in sizes]
        for batch in batches:
            if batch.num_rows:
                x, code = _matrix(batch.column("v"), batch.num_rows), _matrix(batch.column("code"), batch.num_rows)
                for p in range(len(sizes)):
                    counts[p] += np.bincount(code[:, p], minlength=sizes[p][0])
                    np.add.at(totals[p], code[:, p], x[:, limits[p] : limits[p + 1]])
        for p, (entries, width) in enumerate(sizes):
            entry, at = (a.ravel() for a in np.indices((entries, width)))
            columns = np.full(len(entry), p), entry, at, np.repeat(counts[p], width), totals[p].ravel()
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["part", "entry", "at", "n", "total"])

    found = state.select("v", "code").mapInArrow(run, "part long, entry long, at long, n long, total long")
    return found.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def moved_codebooks(state: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry at the floored mean of its rows; entries without rows stay."""
    parts = [p.copy() for p in books.parts]
    for row in _sums(state, books).filter("n > 0").collect():  # one number per part, entry and position
        parts[row["part"]][row["entry"], row["at"]] = row["total"] // row["n"]
    return Codebooks(tuple(parts))


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, group: int = GROUP
) -> tuple[DataFrame, Codebooks | None]:
    """vec_id, label, code array<int> and error of every usable row of `vectors` (vec_id, embedding, label); the final codebooks."""
    rows = settle_table(quantized(vectors, scale), "codes-vectors")
    books = first_codebooks(rows, parts, entries)
    if books is None:
        none = rows.select("vec_id", "label", F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error"))
        return none, None
    history = [books]
    state = rows.filter(F.size("v") == books.dimension)
    for _ in range(rounds):
        state = settle_table(assign(state, history, group), "codes-state")
        history.append(moved_codebooks(state, history[-1]))
    coded = assign(state, history, group).select("vec_id", "label", "code", "error")
    others = rows.filter(F.size("v") != books.dimension).select("vec_id", "label")
    return coded.unionByName(others, allowMissingColumns=True), history[-1]


def code_text(code: Column) -> Column:
    """Two hex digits per index."""
    return F.array_join(F.transform(code, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")


def with_label_error(coded: DataFrame) -> DataFrame:
    """`coded` with label_error: the error summed over the rows of the label, nulls together."""
    coded = settle_table(coded, "codes-coded")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return coded.join(sums, coded["label"].eqNullSafe(sums["_label"]), "left").drop("_label")
