"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words. A document of the source is taken
`target / source_size` times on average, the same expectation for all documents
of the source; a whole part is certain and the fraction is a probability. Pivotal
rounding settles the fractions two at a time: it moves word mass from one document
to the other, up or down at random, until one of the two is taken a whole number
of times. Moves keep the number of words (`size * copies` summed over the pair)
and every document's expectation, so a source misses its target by less than one
document.

Pairing runs as a reduction tree. The documents of a source are dealt by hash into
blocks of bounded size; each block settles all its documents but one; the
residuals of `FAN_IN` blocks meet in a block of the next level; the last residual
of a source is rounded alone. No block grows with the source, so a source with a
third of all rows has more blocks, not larger ones.

Randomness comes from hashes of the seed, the level, the source and the block, and
the rows of a block are sorted first: a task that runs again, or the whole job,
decides alike.

Documents without words are taken `floor(target / source_size)` times (never, in a
source without words) and weigh nothing. Null sources form one source, sorted
last. Equal rows are settled separately. An empty table gives no rows; other
columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import WORD, fresh, numbered, text_of
from stockweave.operators.ranking import rank_rows
from stockweave.session import settle_table

BLOCK_ROWS = 2_000
FAN_IN = 64
_EPS = 1e-9


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """`sizes` (source, source_size, n_docs) with `target`.

    Targets are in the ratio of the weights, which repeat over the sources in
    code point order, and add up to `share` of all words; none exceeds `most`
    times its source's size, the excess going to the others by weight.
    """
    if most < share:
        raise ValueError("the sources cannot hold the share: most must be at least share")
    # nulls last; ranking uses ranges and per-slice totals, not one task over all sources
    ranked = rank_rows(sizes, [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("position") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighted = settle_table(ranked.withColumn("weight", weight).drop("position"), "mix-sources")
    limit = F.lit(float(most)) * F.col("source_size")
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    rate, capped = 0.0, -1
    while True:
        over = limit < F.col("weight") * F.lit(rate) if capped >= 0 else F.lit(False)
        kept, free, now = weighted.agg(
            F.sum(F.when(over, limit).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))), F.sum(over.cast("int"))
        ).first()
        if capped == now or not free:
            break
        # the set of capped sources only grows, so this ends
        rate, capped = (share * total - kept) / free, now
    return weighted.withColumn("target", F.least(limit, F.col("weight") * F.lit(rate))).drop("weight")


def _settle_block(rows: pd.DataFrame, name: str) -> pd.DataFrame:
    """Pair the fractions of one block until at most one document has one."""
    rows = rows.sort_values(["order_hash", "row_id"], kind="stable")
    seed = int.from_bytes(hashlib.sha256(name.encode()).digest()[:8], "big")
    draw = random.Random(seed).random
    whole, size, part = rows["copies"].tolist(), rows["size"].tolist(), rows["part"].tolist()
    held = -1
    for i, x in enumerate(part):
        if x <= _EPS or x >= 1 - _EPS or not size[i]:
            whole[i] += x >= 1 - _EPS
            part[i] = 0.0
            continue
        if held < 0:
            held = i
            continue
        a, b, p, q = size[held], size[i], part[held], part[i]
        up = min((1 - p) * a, q * b)  # words that can move to the held document
        down = min(p * a, (1 - q) * b)  # and from it
        move = up if draw() * (up + down) < down else -down
        p, q = p + move / a, q - move / b
        for j, y in ((held, p), (i, q)):
            whole[j] += y >= 1 - _EPS
            part[j] = y if _EPS < y < 1 - _EPS else 0.0
        held = held if part[held] else i if part[i] else -1
    rows["copies"], rows["part"] = whole, part
    return rows


def _block_settler(seed: int, level: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        source = rows["source"].iloc[0]
        # the source follows a mark, so that a null source differs from any other
        name = f"{seed}/{level}/{rows['block'].iloc[0]}/" + ("" if source is None else f"={source}")
        return _settle_block(rows, name)

    return run


def round_copies(units: DataFrame, seed: int = 17, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Settle `units`: the same rows with whole `copies` and without `part`.

    Needed columns: row_id (unique), source, size, copies long (the certain
    part), part double (the fraction), n_docs long (documents of the source).
    """
    row_hash = F.xxhash64(F.lit(seed), "row_id")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / F.lit(block_rows)))
    level = units.withColumn("order_hash", row_hash).withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "row_id"), blocks))
    at, done = 0, []
    while True:

        settled = level.groupBy("source", "block").applyInPandas(_block_settler(seed, at), level.schema)
        settled = settle_table(settled, "mix-level")
        done.append(settled.filter("part = 0"))
        rest = settled.filter("part > 0")
        # every block of a source leaves one residual at most; alone means decided by its own draw
        if rest.agg(F.max("block")).first()[0] in (None, 0):
            break
        level, at = rest.withColumn("block", F.floor(F.col("block") / FAN_IN)), at + 1
    draw = F.pmod(F.xxhash64(F.lit(seed + 2), F.lit("last"), "row_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    done.append(rest.withColumn("copies", F.col("copies") + (draw < F.col("part")).cast("long")))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("order_hash", "block", "part")


def mix(
    sized: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, seed: int = 17
) -> DataFrame:
    """Copies of each row of `sized` (row_id unique, source, size long; more columns are kept).

    Adds source_size, target and copies long.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    targets = source_targets(sizes, weights, share, most).withColumnRenamed("source", "_source")
    joined = sized.join(targets, sized["source"].eqNullSafe(targets["_source"]), "left").drop("_source")
    expected = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    whole = F.floor(expected + F.lit(_EPS))
    units = joined.withColumn("copies", whole).withColumn("part", F.greatest(expected - whole, F.lit(0.0)))
    return round_copies(units, seed).drop("n_docs")


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """`docs` (text, source, more) with every row as often as the mix takes it."""
    row, times = fresh(docs, "row_id"), fresh(docs, "copies")
    rows = numbered(docs, row, "mix-documents")
    mixed = mix(rows.select(F.col(row).alias("row_id"), "source", word_count(text_of()).alias("size")), weights, share, most)
    taken = mixed.filter("copies > 0").select(F.col("row_id").alias(row), F.col("copies").cast("int").alias(times))
    # two numbers per row are the side to hash; texts are neither sorted nor kept
    joined = rows.join(taken.hint("shuffle_hash"), row)
    return joined.select(*docs.columns, F.explode(F.array_repeat(F.lit(0), F.col(times))).alias(times)).select(*docs.columns)
