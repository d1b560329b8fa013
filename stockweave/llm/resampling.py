"""Importance resampling towards a target distribution, with segment deduplication.

Features are all runs of 1 to `max_run` consecutive words, hashed into buckets. Newlines
separate words, so they cut a text into lines, and a line's features are those that lie
inside it. Distinct lines are found by one aggregate that combines before the shuffle;
each is cut into words and hashed once, and the corpus totals take its bucket counts
times its occurrences. Runs that cross from one line into the next ones, which only exist
where `max_run` is above 1, are counted per text and added separately. The target texts
are counted the same way.

A bucket's gain compares its share in the target with that in the corpus, both with one
added. Gains are an array of `buckets` numbers, the only thing that passes through
the driver and into the tasks. Every distinct line then has one sum of gains, which
the texts that hold the line look up by its SHA-256; a line that many texts hold is one row on
the unique side of that join, so a hot line can be split on the other side. A text's weight is the
mean of its gains, its score adds Gumbel noise drawn from its id, and the highest scores
win: sampling without replacement in proportion to the weights. Ranks come from a range
partitioning of slim rows.

A-Z are lower-cased. Null and empty texts, and those without words, have no features and
weight 0, and are never drawn where words are asked for. A null doc_id counts as an empty id and
comes last among equal scores. Repeated rows are texts of their own: they count each, have the same
score and may both be drawn. An empty table gives no rows; an empty target gives gains
of its added ones. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import text_of
from stockweave.operators.ranking import rank_rows
from stockweave.session import settle_table

BUCKETS = 10_000
MAX_RUN = 1
LEAST_WORDS = 20
SHARE = (10, 100)
SEED = "2024"
# distinct words whose bucket a task remembers
REMEMBERED = 1 << 18

# bytes of words: digits, a-z and all bytes of characters beyond ASCII; A-Z become a-z
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_SOME_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


class _Buckets:
    """Bucket numbers of features."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.known: dict[bytes, int] = {}

    def of_words(self, words: list[bytes]) -> list[int]:
        known, out = self.known, []
        for word in words:
            bucket = known.get(word)
            if bucket is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                bucket = known[word] = zlib.crc32(word) % self.buckets
            out.append(bucket)
        return out

    def of_runs(self, words: list[bytes], starts, n: int) -> list[int]:
        return [zlib.crc32(b" ".join(words[i : i + n])) % self.buckets for i in starts]

    def inside(self, words: list[bytes], max_run: int) -> list[int]:
        """Of all runs in one line."""
        found = self.of_words(words)
        for n in range(2, max_run + 1):
            found += self.of_runs(words, range(len(words) - n + 1), n)
        return found

    def across(self, lines: list[list[bytes]], max_run: int) -> list[int]:
        """Of all runs that cross the end of a line."""
        words = [w for line in lines for w in line]
        ends = np.cumsum([len(line) for line in lines])[:-1]
        found: list[int] = []
        for n in range(2, max_run + 1):
            starts = {s for e in ends.tolist() for s in range(max(0, e - n + 1), min(e, len(words) - n + 1))}
            found += self.of_runs(words, sorted(starts), n)
        return found


def _ints(rows: list[list[int]]) -> pa.ListArray:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.fromiter((x for r in rows for x in r), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _counts(rows: list[list[int]], buckets: int) -> tuple[pa.ListArray, pa.ListArray]:
    """Distinct buckets of each row, and how often each occurs."""
    owner = np.repeat(np.arange(len(rows), dtype=np.int64), [len(r) for r in rows])
    flat = np.fromiter((x for r in rows for x in r), np.int64, len(owner))
    pairs, n = np.unique(owner * buckets + flat, return_counts=True)
    offsets = np.searchsorted(pairs, np.arange(len(rows) + 1, dtype=np.int64) * buckets).astype(np.int32)
    at = pa.array(offsets)
    return pa.ListArray.from_arrays(at, pa.array((pairs % buckets).astype(np.int32))), pa.ListArray.from_arrays(at, pa.array(n.astype(np.int32)))


_CUT = "doc_id {kind}, row_id long, lines array<binary>, crossing array<int>"


def cut_texts(docs: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, row_id, lines (SHA-256 of every line with a word) and crossing (buckets of runs over line ends), written once."""
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row_id"), text_of().cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = _Buckets(buckets)
        for batch in batches:
            keys, crossing = [], []
            for text in batch.column("text").to_pylist():
                lines = [line for line in text.split(b"\n") if _SOME_WORD.search(line)]
                keys.append([hashlib.sha256(line).digest() for line in lines])
                crossing.append(hashed.across([words_of(line) for line in lines], max_run) if max_run > 1 else [])
            listed = pa.array(keys, pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_id"), listed, _ints(crossing)], ["doc_id", "row_id", "lines", "crossing"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return settle_table(rows.mapInArrow(run, _CUT.format(kind=kind)), "resample-texts")


def line_features(docs: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS) -> DataFrame:
    """key (SHA-256), times, n_words, bucket array and count array of every distinct line with a word, written once."""
    lines = docs.select(F.explode(F.split(text_of(), "\n", -1)).alias("line"))
    distinct = lines.filter(F.rlike("line", F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]"))).groupBy("line").agg(F.count("*").alias("times"))
    rows = distinct.select(F.unhex(F.sha2("line", 256)).alias("key"), "times", F.col("line").cast("binary").alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = _Buckets(buckets)
        for batch in batches:
            found = [words_of(line) for line in batch.column("line").to_pylist()]
            bucket, count = _counts([hashed.inside(words, max_run) for words in found], buckets)
            n_words = pa.array([len(words) for words in found], pa.int64())
            names = ["key", "times", "n_words", "bucket", "count"]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("times"), n_words, bucket, count], names)

    features = rows.mapInArrow(run, "key binary, times long, n_words long, bucket array<int>, count array<int>")
    return settle_table(features, "resample-lines")


def bucket_totals(features: DataFrame, texts: DataFrame) -> DataFrame:
    """bucket and n: features of all lines times their occurrences, and those across lines."""
    within = features.select("times", F.inline(F.arrays_zip("bucket", "count"))).select("bucket", (F.col("times") * F.col("count")).alias("n"))
    across = texts.select(F.explode("crossing").alias("bucket"), F.lit(1).cast("long").alias("n"))
    return within.unionByName(across).groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * ln(share in the target / share in the corpus)) of every bucket, by number."""
    every = corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    counted = every.join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
    counted = counted.select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t"))
    counted = settle_table(counted, "resample-buckets")
    total = counted.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    ratio = (F.col("t") + 1).cast("double") * F.lit(float(total["s"] + buckets)) / ((F.col("s") + 1).cast("double") * F.lit(float(total["t"] + buckets)))
    gains = np.zeros(buckets, np.int64)
    for row in counted.select("bucket", F.floor(1000 * F.ln(ratio)).alias("gain")).collect():  # one row a bucket
        gains[row["bucket"]] = row["gain"]
    return gains


def _sums(lists: pa.Array, values: np.ndarray) -> np.ndarray:
    """Sum of `values` over each list."""
    offsets = np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]
    running = np.r_[0, np.cumsum(values)]
    return running[offsets[1:]] - running[offsets[:-1]]


def _line_sums(features: DataFrame, gains: np.ndarray) -> DataFrame:
    """key, n_words, n_features and gain of every distinct line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = batch.column("bucket").flatten().to_numpy(zero_copy_only=False)
            count = batch.column("count").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            lists = batch.column("bucket")
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n_words"), pa.array(_sums(lists, count)), pa.array(_sums(lists, gains[bucket] * count))],
                ["key", "n_words", "n_features", "gain"],
            )

    rows = features.select("key", "n_words", "bucket", "count")
    return rows.mapInArrow(run, "key binary, n_words long, n_features long, gain long")


def _crossing_sums(texts: DataFrame, gains: np.ndarray) -> DataFrame:
    """row_id, n_words (0), n_features and gain of the runs across lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("crossing")
            sums = _sums(lists, gains[lists.flatten().to_numpy(zero_copy_only=False)])
            n = lists.value_lengths().cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), n, pa.array(sums)], ["row_id", "n_features", "gain"])

    rows = texts.filter(F.size("crossing") > 0).select("row_id", "crossing")
    found = rows.mapInArrow(run, "row_id long, n_features long, gain long")
    return found.select("row_id", F.lit(0).cast("long").alias("n_words"), "n_features", "gain")


def importance_weights(docs: DataFrame, target: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, row_id, n_words, n_features and weight of every row of `docs`; `target` has a column text."""
    texts, features = cut_texts(docs, max_run, buckets), line_features(docs, max_run, buckets)
    wanted = target.select(F.lit(0).cast("long").alias("doc_id"), "text")
    goal = bucket_totals(line_features(wanted, max_run, buckets), cut_texts(wanted, max_run, buckets))
    gains = bucket_gains(bucket_totals(features, texts), goal, buckets)
    values = settle_table(_line_sums(features, gains), "resample-values")
    held = texts.select("row_id", F.explode("lines").alias("key"))
    parts = held.join(values, "key").select("row_id", "n_words", "n_features", "gain")
    if max_run > 1:
        parts = parts.unionByName(_crossing_sums(texts, gains))
    none = F.lit(0).cast("long")
    rows = texts.select("doc_id", "row_id", none.alias("n_words"), none.alias("n_features"), none.alias("gain"))
    every = rows.unionByName(parts, allowMissingColumns=True)
    sums = every.groupBy("row_id").agg(
        F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n_words", "n_features", "gain")]
    )
    floored = F.expr("(gain - pmod(gain, n_features)) div n_features")
    weight = F.when(F.col("n_features") > 0, floored).otherwise(F.lit(0)).cast("long")
    return sums.select("doc_id", "row_id", "n_words", "n_features", weight.alias("weight"))


def gumbel_noise(seed: str = SEED):
    """floor(1000 * standard Gumbel noise), drawn from the hash of seed and doc_id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: tuple[int, int] = SHARE,
    least_words: int = LEAST_WORDS,
    max_run: int = MAX_RUN,
    buckets: int = BUCKETS,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of `docs` (doc_id, text).

    Of the rows with `least_words` words or more the `share` (a fraction) with the highest scores is drawn and ranked.
    """
    weighed = importance_weights(docs, target, max_run, buckets)
    scored = settle_table(weighed.withColumn("score", F.col("weight") + gumbel_noise(seed)), "resample-scores")
    able = scored.filter(F.col("n_words") >= least_words)
    quota = able.count() * share[0] // share[1]
    ranked = rank_rows(able.select("row_id", "doc_id", "score"), [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row_id")], "rank")
    drawn = ranked.filter(F.col("rank") <= quota).select("row_id", F.col("rank").cast("long").alias("rank"))
    return scored.join(drawn, "row_id", "left").select("doc_id", "n_words", "n_features", "weight", "score", "rank")
